"""Operators for large training corpora: dedup, filters, tokens, packing, chat records."""
