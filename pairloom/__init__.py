"""Entity resolution, pair analytics and training-data preparation on Spark DataFrames."""
