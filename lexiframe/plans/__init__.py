"""Registered queries, one module for each family."""

from __future__ import annotations

from lexiframe.plans import feed, layers, parsing, relational, state, structure, wording
from lexiframe.registry import Registry

FAMILIES = (state, layers, structure, wording, parsing, feed, relational)


def catalogue() -> Registry:
    registry = Registry()
    for family in FAMILIES:
        family.register(registry)
    return registry
