"""Column expressions. All of them stay on the JVM; there is no Python UDF."""
