"""Corpus-to-clip analytics on Spark: declarative operators over DataFrames."""
