"""Scalar functions, all built from JVM-side expressions."""
