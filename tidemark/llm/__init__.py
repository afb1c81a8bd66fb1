"""Operators for preparing training data: duplicates, search, licences, tokens, mixing, output."""
