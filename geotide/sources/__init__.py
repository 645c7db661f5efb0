"""Feeds and files turned into canonical DataFrames, and the store they are written to."""
