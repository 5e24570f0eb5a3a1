"""Whole jobs: read, compute, stage, publish."""
