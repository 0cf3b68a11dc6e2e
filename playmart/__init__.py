"""playmart: star-schema ELT, serving tables and usage reports on Spark DataFrames."""
