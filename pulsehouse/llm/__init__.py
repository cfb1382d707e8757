"""Training-data operators: classifiers, near-duplicates, mixing, packing, chat, search."""
