"""Operators for building training corpora from tables of documents."""
