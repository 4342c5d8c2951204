"""A Spark-native engine for tournament data; every operator maps DataFrames to a DataFrame."""
