"""Training-data operators: filters, dedup, decontamination, mixing, tokens."""
