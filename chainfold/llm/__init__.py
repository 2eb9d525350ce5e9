"""Operators for large text corpora: deduplication, extraction, tokens, mixing, chat, quality, safety, search."""
