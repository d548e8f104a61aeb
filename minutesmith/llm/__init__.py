"""Training-data operators: ten Spark jobs that share nothing with the rest of the library."""
