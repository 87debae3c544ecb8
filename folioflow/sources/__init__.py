"""Readers and writers: object listings, events, page records, the chunk store."""
