"""Operators for preparing large text corpora, and their named queries."""
