"""Structured Streaming jobs that keep the keyed tables up to date."""
