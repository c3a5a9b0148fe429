"""Readers, writers and nested-source access."""
