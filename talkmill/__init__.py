"""Conversation analytics on Spark: catalogs of recorded conversations as DataFrames."""
