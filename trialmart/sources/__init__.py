"""Reading, searching and writing trial data."""
