"""Registered queries: DataFrame plans and their SQL twins."""
