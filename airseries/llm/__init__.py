"""Training-data operators: scoring, deduplication, filtering, decontamination, packing."""
