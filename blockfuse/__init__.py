"""blockfuse: consensus fusion of address-block opinions, built on Spark DataFrames."""
