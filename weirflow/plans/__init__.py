"""Whole queries: inputs derived from the stored tables, and what is asked of them."""
