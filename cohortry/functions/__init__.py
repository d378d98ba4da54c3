"""Column expressions and small aggregates; everything stays inside the JVM."""
