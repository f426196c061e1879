"""Operators over DataFrames: sequences, matching, publication, quality."""
