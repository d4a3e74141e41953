"""Column expressions; every one stays inside the JVM (no Python UDFs)."""
