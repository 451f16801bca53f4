"""Registered queries: the operators bound to the driver's tables."""

from __future__ import annotations

import importlib
import pkgutil


def load_catalog():
    """Import every plan module, so that each registers its queries, and return the catalogue."""
    from umbral.plans import catalog
    for m in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{m.name}")
    return catalog
