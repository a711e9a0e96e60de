"""Column expressions: parsing, rules and value clean-up. All run inside the JVM."""
