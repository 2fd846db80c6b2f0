"""Event-stream analytics on Spark: operators that work on tables and on streams alike."""
