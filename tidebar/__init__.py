"""Market-data analytics on Spark: functions from DataFrames to a DataFrame, over all symbols at once."""
