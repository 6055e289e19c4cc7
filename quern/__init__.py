"""quern: corpus curation, quality filtering and evaluation on Spark DataFrames."""
