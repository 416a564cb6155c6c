"""Scalar functions: each takes columns and returns a column of built-in expressions, unless it says otherwise."""
