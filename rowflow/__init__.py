"""Keyed change replication and sync analytics on Spark DataFrames."""
