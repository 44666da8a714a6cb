"""Relational and Arrow-backed operators over DataFrames."""
