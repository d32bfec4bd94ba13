"""Etymological graph analytics and text-collection processing on Spark DataFrames."""
