"""Streaming of the football analytics library."""
