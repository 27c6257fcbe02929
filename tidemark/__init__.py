"""tidemark: layered batch analytics for e-commerce data on Spark DataFrames."""
