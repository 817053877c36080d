"""Operators over documents, sections, chunks and vectors."""
