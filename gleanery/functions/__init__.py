"""Column-to-column building blocks (no joins, no shuffles)."""
