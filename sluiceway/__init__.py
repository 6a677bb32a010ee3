"""Ingestion and data-quality jobs for Spark.

Responses, dropped files and relational changes go from append-only bronze tables to keyed
silver tables and monitoring aggregates. See README.md for the map of modules.
"""
