"""Derived tables and the queries served from them."""
