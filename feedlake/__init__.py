"""feedlake: ingestion, reshaping and governance operators for periodic deliveries, on Spark DataFrames."""
