"""Network-flow analytics and training-data operators composed from Spark DataFrames."""
