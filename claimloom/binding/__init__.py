"""Binds the library to TPC-H-like driver tables (raw-shaped views and SQL oracles)."""
