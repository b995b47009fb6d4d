"""Column-level building blocks (no DataFrame in, none out)."""
