"""Readers, writers and the entity registry."""
