"""Readers of the wire formats, writers, and a generator of test corpora."""
