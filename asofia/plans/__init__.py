"""Driver queries and their SQL."""
