"""Text retrieval, graph ranking and recommendation over review tables, on Spark DataFrames."""
