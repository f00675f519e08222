"""Imports every catalogue module so that its queries register."""

from importlib import import_module

from millrace.plans.registry import CATALOGUE

MODULES = ("catalog_cleanse", "catalog_joins", "catalog_windows", "catalog_versions", "catalog_sources", "catalog_series", "catalog_models", "catalog_events", "catalog_streams")

for _module in MODULES:
    import_module(f"millrace.plans.{_module}")

__all__ = ["CATALOGUE"]
