"""Operators: DataFrame -> DataFrame transformations of each layer."""
