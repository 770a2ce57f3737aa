"""Named queries over the test tables, each with the SQL that checks it."""

from importlib import import_module

FAMILIES = ("corpus", "sequences", "preparation", "scoring", "runs")


def load():
    """Import all families of queries and return the registry."""
    for family in FAMILIES:
        import_module(f"corpusflow.plans.{family}")
    return import_module("corpusflow.plans.registry")
