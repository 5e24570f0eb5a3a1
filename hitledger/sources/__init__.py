"""Scans: raw text lines, the partitioned log, statistics and dimension files."""
