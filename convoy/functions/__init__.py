"""Column expressions shared by the operators. All compile to JVM built-ins."""
