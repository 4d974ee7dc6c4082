"""Training-data operators: near-duplicates, filters, tokens, mixing."""
