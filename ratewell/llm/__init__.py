"""Operators for preparing training text: extraction, deduplication, filtering, tokens and archives."""
