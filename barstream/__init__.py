"""Market bars on Spark: parsing, flattening, querying, streaming and upkeep."""
