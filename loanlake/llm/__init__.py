"""Training-data operators: near-dedup, search, packing, tokenising, sharding, scoring, cleaning, WARC."""
