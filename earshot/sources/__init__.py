"""Table schemas, readers and writers."""
