"""Training-data operators: dedup, search, archives, scoring, formatting, mixing."""
