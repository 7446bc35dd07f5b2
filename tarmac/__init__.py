"""Flight on-time analytics on Apache Spark: DataFrames in, DataFrames out."""
