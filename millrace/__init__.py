"""Data preparation, quality, warehouse and mining operators on Spark DataFrames."""
