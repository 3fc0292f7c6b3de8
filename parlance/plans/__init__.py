"""The analyses a user runs, grouped by subject."""
