"""Imports every query module, so that the registry is complete."""

from importlib import import_module

MODULES = ["normalise", "loading", "resolving", "linking", "scored", "marted", "tracked"]

for _module in MODULES:
    import_module(f"{__package__}.{_module}")

from .registry import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES"]
