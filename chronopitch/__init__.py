"""Point-in-time analytics on Spark: DataFrame in, DataFrame out."""
