"""Column expressions: text, dates, numbers. Everything here stays inside the JVM."""
