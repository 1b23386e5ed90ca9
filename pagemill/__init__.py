"""Batch analytics over page traffic, edit history and link graphs, on Spark DataFrames."""
