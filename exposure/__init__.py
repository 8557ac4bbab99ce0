"""Attack-surface inventory analytics on Spark: DataFrames in, DataFrames out."""
