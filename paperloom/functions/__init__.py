"""Column-to-column functions. All of them stay in the JVM."""
