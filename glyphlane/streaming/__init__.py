"""Incremental forms of the stateless jobs."""
