"""Operators over text and very large numeric columns for training data. Nothing else in the library imports this."""
