"""Star-schema analytics over event messages, written as Spark DataFrame operators."""
