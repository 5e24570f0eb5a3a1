"""Relational building blocks, DataFrame in and DataFrame out."""
