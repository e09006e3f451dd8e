"""Training-data operators: fingerprints, search, formatting, dedup, packing, scoring, mixing, archives."""
