"""Preparation of training text: deduplication, archives, packing, scoring, search, mixing."""
