"""Training-data pipeline operators: scoring, de-duplication, mixing, packing, token output."""
