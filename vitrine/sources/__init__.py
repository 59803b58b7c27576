"""Table schemas and scans: facts, sessions, point-of-sale lines, catalogs."""
