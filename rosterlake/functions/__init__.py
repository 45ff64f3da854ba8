"""Column expressions. Everything here runs in the JVM except the Arrow kernels in ``vectors``."""
