"""Listing-condition analytics expressed as Spark DataFrame operations."""
