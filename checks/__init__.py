"""Registered queries with their oracle SQL."""
from importlib import import_module

SUBJECTS = ["structure", "users", "localtime", "devices", "harm", "languages", "models"]


def all_checks() -> dict:
    checks = {}
    for subject in SUBJECTS:
        checks.update(import_module(f"{__name__}.{subject}").CHECKS)
    return checks
