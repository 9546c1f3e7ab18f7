"""DataFrame operators: cleaning, quality, change capture, lookups."""
