"""Sales analytics for Spark: batch indicators and event streams over DataFrames."""
