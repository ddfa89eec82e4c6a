"""Readers, writers and the claims domain views."""
