"""Strandwise: Spark operators for viral-sequence tables and for large text corpora."""
