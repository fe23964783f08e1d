"""Training-data operators: scoring, dedup, privacy, search, packing and token output."""
