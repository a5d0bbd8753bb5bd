"""Layered (bronze / silver / gold) batch analytics on Spark DataFrames."""
