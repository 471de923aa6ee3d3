"""Package of DataFrame-to-DataFrame building blocks."""
