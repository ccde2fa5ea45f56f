"""Column-level building blocks (JVM expressions, no Python per row)."""
