"""Spark jobs over distributed-trace spans: dependencies, call paths, quality."""
