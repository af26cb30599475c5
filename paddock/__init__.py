"""paddock: race-style analytics and data-quality operators on Spark DataFrames."""
