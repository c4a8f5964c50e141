"""Every operator as a runnable query with its oracle SQL."""

from importlib import import_module

ALL_MODULES = [import_module(f"catalog.{m}") for m in ("cleaning", "sources", "quality", "etl", "relations", "functions", "features", "bias", "models", "monitoring", "streams")]
