"""DNS traffic analytics as Spark DataFrames."""
