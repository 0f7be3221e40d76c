"""revlens."""
