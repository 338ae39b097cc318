"""Registered queries over the given tables, by family."""

from importlib import import_module

FAMILIES = ("valuation", "identity", "groups", "listings", "reconcile", "evidence", "audit", "feeds")


def load():
    """Import every family once and return the registry."""
    for family in FAMILIES:
        import_module(f"listwise.workloads.{family}")
    return import_module("listwise.workloads.registry")
