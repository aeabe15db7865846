"""Build and search a corpus of crawled paper pages with Spark DataFrames."""
