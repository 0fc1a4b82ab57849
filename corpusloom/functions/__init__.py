"""Column expressions on text: pure functions of columns, evaluated in the JVM."""
