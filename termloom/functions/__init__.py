"""Column expressions. None of them shuffles, and all but user callbacks stay in the JVM."""
