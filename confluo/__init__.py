"""Record linkage and survivorship on Spark DataFrames."""
