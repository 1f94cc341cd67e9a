"""Column expressions: identity, text, HTML, dates. All of them run inside the JVM."""
