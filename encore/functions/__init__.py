"""Column expressions. Every function takes and returns ``Column`` and stays in the JVM."""
