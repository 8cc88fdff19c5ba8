"""Readers, writers and file facts."""
