"""Column functions, all built from Spark expressions that run in the JVM."""
