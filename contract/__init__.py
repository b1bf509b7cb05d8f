"""Driver contract: the driver's tables in the roles of the data model, queries and oracles."""

from importlib import import_module


def load():
    """Import every module that registers queries and return the registry."""
    for name in ("profiling", "auditing", "cleaning", "serving", "validation", "storing"):
        import_module(f"contract.{name}")
    return import_module("contract.registry")
