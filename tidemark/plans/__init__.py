"""Named query plans over the given tables and their oracle SQL."""
