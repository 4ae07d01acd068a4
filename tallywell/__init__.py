"""Commerce analytics on Spark: messages in, clean tables and KPIs out."""
