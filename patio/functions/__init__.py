"""Column expressions. All stay inside the JVM; there is no Python UDF."""
