"""Column expressions used by the jobs: all native, none row-at-a-time."""
