"""Storm-track and polar-array analytics, declared as Spark DataFrames."""
