"""Corpus operators for training-data pipelines (documents and pages in, documents or digests out).

Nothing outside this subpackage imports it; ``queries.py`` holds the registered queries.
"""
