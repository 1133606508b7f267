"""Feature and model-data jobs for tabular data, written as Spark DataFrame transformations."""
