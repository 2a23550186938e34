"""Warehouse operators: cleaning, star schema, merge, history, ranking, quality."""
