"""Operators on DataFrames and the estimators that freeze fitted decisions."""
