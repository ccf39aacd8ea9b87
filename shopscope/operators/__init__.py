"""Building blocks: cleaning, exploding, keyed tables, item pairs."""
