"""Relational building blocks shared by the analyses."""
