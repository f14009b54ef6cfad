"""Analytic operators: DataFrame in, DataFrame out, no action inside."""
