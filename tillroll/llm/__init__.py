"""Operators for building training corpora: archives, filters, deduplication, classifiers, mixing, scoring."""
