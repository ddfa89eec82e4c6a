"""Relational operators over claims, entities, scores and places."""
