"""Operators on tables of hits, taxa, clusters, reads, alignments and variants."""
