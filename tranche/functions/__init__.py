"""Column-expression building blocks (pure, JVM-side, codegen friendly)."""
