"""Operators for preparing training text: each module holds one, built on DataFrames."""
