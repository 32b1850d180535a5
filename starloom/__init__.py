"""Star-schema ELT and analytics on Spark DataFrames."""
