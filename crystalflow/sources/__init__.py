"""Readers: documents, listings, index pages, paged services, dumps."""
