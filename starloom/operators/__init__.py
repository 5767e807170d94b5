"""Reusable DataFrame operators: ordering, dimensions, history, facts, baskets, checks."""
