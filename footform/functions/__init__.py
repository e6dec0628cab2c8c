"""Functions of the football analytics library."""
