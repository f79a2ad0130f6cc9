"""Readers of event streams, static feeds and tables."""
