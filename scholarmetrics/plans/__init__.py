"""Workflows composed from the operators, the registered query catalog, its
DuckDB SQL twins, and plan inspection helpers."""
