"""Catalog building on Spark: extract, merge, enrich, validate, publish."""
