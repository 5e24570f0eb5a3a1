"""Writers: partitioned tables, delimited files, result logs, catalog."""
