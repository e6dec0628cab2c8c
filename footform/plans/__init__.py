"""Plans of the football analytics library."""
