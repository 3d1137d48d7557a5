"""Readers, writers and scratch storage."""
