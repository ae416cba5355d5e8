"""All queries of the engine itself."""

from __future__ import annotations

from gridloom.queries import banks, calls, spaces
from gridloom.registry import Registry

REGISTRY = Registry()
for _module in (spaces, banks, calls):
    _module.register(REGISTRY)
