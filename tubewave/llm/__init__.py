"""Operators for preparing training data: cleaning, duplicates, packing and token files."""
