"""Readers, writers and shared storage."""
