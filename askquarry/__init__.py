"""Retrieval and answering over document collections, written on Spark DataFrames."""
