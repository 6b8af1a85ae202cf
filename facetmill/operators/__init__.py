"""DataFrame operators. Each takes DataFrames and column names."""
