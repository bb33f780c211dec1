"""Column-expression helpers: everything here returns a ``Column`` and stays JVM-side."""
