"""Composable operators: DataFrames in, a DataFrame out."""
