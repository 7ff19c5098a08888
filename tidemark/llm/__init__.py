"""Operators for training data: text, web pages, near duplicates, mixing, and their queries."""
