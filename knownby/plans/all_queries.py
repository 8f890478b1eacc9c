"""Imports every plan module so that its queries register."""

from __future__ import annotations

import importlib

MODULES = ("kernel", "records", "reconciliation", "consistency", "extraction", "market", "research", "boundaries")


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"knownby.plans.{name}")
