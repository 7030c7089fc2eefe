"""DataFrame operators. Each takes DataFrames, column names and thresholds."""
