"""lodestat: text mining and statistical learning on Spark DataFrames."""
