"""Column expressions: text, numbers, casts.  All run inside the JVM."""
