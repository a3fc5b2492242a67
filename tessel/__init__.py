"""Tabular regression on Spark: fitted table transforms, splits, models, search and stacking."""
