"""Column functions: they take Columns and return Columns, and never shuffle."""
