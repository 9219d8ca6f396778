"""Registered queries with their SQL twins, one module per area."""
