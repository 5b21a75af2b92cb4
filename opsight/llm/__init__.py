"""Operators for preparing training data: scoring, extraction, deduplication, packing and mixing of documents."""
