"""Column expressions: every function here maps Column to Column and runs in the JVM."""
