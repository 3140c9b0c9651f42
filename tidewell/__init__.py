"""tidewell: a Spark-first engine for commerce lakehouse tables and their data problems."""
