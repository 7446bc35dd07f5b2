"""All registered queries and their reference SQL."""

from __future__ import annotations

from tarmac.registry import checks, core, storage, streams

_MODULES = (core, storage, checks, streams)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: text for module in _MODULES for name, text in module.ORACLES.items()}
