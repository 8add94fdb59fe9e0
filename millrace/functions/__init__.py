"""Column expressions: text, numbers, bands and dates. All of them stay inside the JVM."""
