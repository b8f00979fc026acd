"""Loaders of source files into the declared node and edge tables."""
