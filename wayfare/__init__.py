"""Trip-marketplace analytics on Spark: batch star schema, event windows, monitoring."""
