"""Training-data operators: deduplication, filtering, tokenising, formatting, search and packing."""
