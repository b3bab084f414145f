"""Composed plans: the lazy end-to-end graph, the query registry and its SQL oracle."""
