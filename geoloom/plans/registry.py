"""All reference-domain queries by name, with the DuckDB SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from geoloom.plans import catalogue, jobs, pixels, points, refine, space

_ALL = points.QUERIES | space.QUERIES | catalogue.QUERIES | jobs.QUERIES | refine.QUERIES | pixels.QUERIES
QUERIES: dict[str, Callable] = {k: q for k, (q, _) in _ALL.items()}
ORACLES: dict[str, str] = {k: s for k, (_, s) in _ALL.items() if s}
FLAGSHIP = "q_block_tiles"
