"""All core queries by name, with their SQL."""

from __future__ import annotations

from lavra.plans import core, quality, sources

_MODULES = (core, sources, quality)
QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in _MODULES for k, s in m.SQL.items()}
FLAGSHIP = core.batch_final_records
