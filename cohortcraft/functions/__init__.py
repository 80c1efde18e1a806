"""Column-level helpers (all return ``Column`` expressions, no actions)."""
