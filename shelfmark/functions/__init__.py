"""Column expressions: Column in, Column out, evaluated inside the JVM unless stated otherwise."""
