"""Readers: object listings, graph triples, pages and work-package files."""
