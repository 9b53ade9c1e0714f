"""Registered queries with their oracle SQL, on inputs derived from the given tables."""
