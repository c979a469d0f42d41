"""tessera: cohort assembly, auditing and release on Spark DataFrames."""
