"""Readers of the feeds, the lake and the result tables."""
