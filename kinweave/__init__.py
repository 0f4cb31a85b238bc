"""Customer record linkage, survivorship and governed serving on Spark DataFrames."""
