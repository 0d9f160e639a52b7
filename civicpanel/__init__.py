"""Public-indicator analytics on Spark: measures, long fact table, comparisons."""
