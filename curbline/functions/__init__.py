"""Column functions: every one builds JVM-side expressions, none is a Python UDF."""
