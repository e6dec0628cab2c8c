"""Operators of the football analytics library."""
