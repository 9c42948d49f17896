"""Building blocks: each maps DataFrames to a DataFrame and runs no Python per row."""
