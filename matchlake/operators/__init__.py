"""Relational steps over match rows."""
