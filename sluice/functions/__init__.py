"""Cell-level functions (Column -> Column)."""
