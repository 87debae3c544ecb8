"""Operators for preparing training text: deduplication, filters, tokenizers, chat and document quality."""
