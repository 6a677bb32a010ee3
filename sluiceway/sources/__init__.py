"""Readers: control tables, request specs, responses, files, relational tables."""
