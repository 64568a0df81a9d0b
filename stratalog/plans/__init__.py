"""Whole refresh runs built from the operators."""
