"""Column functions; all stay inside the JVM unless a module says otherwise."""
