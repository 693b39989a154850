"""Column expressions. All run inside the JVM, but for the optional `entities`."""
