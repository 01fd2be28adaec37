"""Column expressions that need no shuffle."""
