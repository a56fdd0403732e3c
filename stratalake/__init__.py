"""Layered (bronze -> silver -> gold) analytical tables on Spark DataFrames."""
