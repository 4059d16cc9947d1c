"""Frame-level operators: conform, load, counts."""
