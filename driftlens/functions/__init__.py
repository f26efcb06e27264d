"""Column helpers. Every one is composed of Spark built-ins and stays inside the JVM."""
