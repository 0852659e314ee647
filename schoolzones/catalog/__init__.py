"""Queries over the driver's tables, each with the SQL that must give the same rows."""

import importlib

MODULES = "scans cleaning rows joining grouping ordering reshaping classes shapes workflows streams".split()


def register_all() -> None:
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
