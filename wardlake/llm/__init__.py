"""Training-data operators: search, mixing, counting, scoring, packing, near-duplicates, filters, media."""
