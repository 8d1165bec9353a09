"""Table sources, zones and named extracts."""
