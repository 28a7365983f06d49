"""Basin feature engine and corpus tools on Spark DataFrames."""
