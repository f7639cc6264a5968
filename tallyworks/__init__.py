"""Production costing, file-quality scoring and fixed-width export on Spark DataFrames."""
