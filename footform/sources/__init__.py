"""Sources of the football analytics library."""
