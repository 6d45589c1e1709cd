"""Operators for training data: sampling, mixing, percentiles, tokenizing, truncation. Nothing outside imports this."""
