"""Corpus-preparation operators: formatting, extraction, archives, tokens, dedup, filters."""
