"""Training-data operators: deduplication, tokens, packing, archives, page text, sharding, privacy, quality."""
