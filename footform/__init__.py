"""footform: football form and odds analytics as Spark DataFrame operators."""
