"""Operators on text corpora: quality, duplicates, mixing, packing and the like."""
