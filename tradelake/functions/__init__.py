"""Column-level helpers (Column -> Column) and name utilities."""
