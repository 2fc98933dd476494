"""Readers for tables and streams."""
