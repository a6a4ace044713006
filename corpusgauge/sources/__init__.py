"""Readers and writers for relations, payloads, records, listings and motion clips."""
