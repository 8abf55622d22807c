"""Training-data operators: scoring, filtering, near-duplicate search and packing of documents."""
