"""Operators: DataFrame in, DataFrame out, nothing executed."""
