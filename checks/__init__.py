"""Queries over the driver's tables, with the SQL that must give the same rows."""


def load() -> dict:
    """All registered checks by name."""
    from checks import cleaning, clusters, descriptions, features, learning, profiles, scores, tables  # noqa: F401
    from checks.registry import CHECKS

    return CHECKS
