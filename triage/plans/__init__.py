"""Whole runs, registered queries and their oracle SQL."""
