"""Company-record loading, cleaning, linking, enrichment, scoring and validation on Spark DataFrames."""
