"""Readers: drop directories, topics, database tables."""
