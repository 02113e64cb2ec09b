"""A dataset-curation engine on Spark DataFrames."""
