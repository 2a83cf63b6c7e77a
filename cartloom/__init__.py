"""Relational commerce data on Spark: generate, verify, fingerprint, mutate, publish, query."""
