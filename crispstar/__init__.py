"""Clean dirty business tables with Spark and serve them as a star schema."""
