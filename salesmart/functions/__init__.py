"""Column-level building blocks (built-in Spark functions only)."""
