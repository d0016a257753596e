"""Training-data operators: quality, dedup, decontamination, mixing, tokens, HTML, LM and secrets."""
