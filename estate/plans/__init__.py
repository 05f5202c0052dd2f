"""Operators that emit ordered statements as rows; running them is left to the caller."""
