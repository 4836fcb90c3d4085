"""Named queries over the test tables, each with the SQL it is checked against."""

from __future__ import annotations

from importlib import import_module

from . import base

for _module in ("sources", "scalars", "relational", "products", "quality", "security", "graph",
                "geo", "learning", "telemetry", "streams", "refreshing"):
    import_module(f"{__name__}.{_module}")

QUERIES = base.QUERIES
ORACLES = {name: base.compose(sql) for name, sql in base.ORACLES.items()}
