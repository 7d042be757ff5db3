"""Sources: raw booking scans, lookup tables, test fixtures from driver tables."""
