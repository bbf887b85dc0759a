"""Column expressions: every one stays inside the JVM and reads no session state."""
