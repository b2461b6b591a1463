"""Operators for large text corpora: cleaning, matching, scoring and mixing."""
