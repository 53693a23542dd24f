"""Column-level helpers (pure ``Column -> Column`` expressions)."""
