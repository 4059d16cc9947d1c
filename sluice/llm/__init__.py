"""Training-data operators: dedup, tokenizing, filters, scoring, mixing."""
