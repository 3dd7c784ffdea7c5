"""Operators over DataFrames: statistics, cleaning, encoding, association, splits."""
