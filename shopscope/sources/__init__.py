"""Reading the entities, landing them as Parquet, writing results."""
