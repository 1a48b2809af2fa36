"""Registered queries and their SQL oracles, gathered from the modules of this package."""

from __future__ import annotations

from quern.plans import audits, companies, filings, keyed, market, periods, projections, scalars, scale

QUERIES: dict = {}
ORACLES: dict = {}
for _module in (keyed, periods, market, companies, filings, audits, projections, scalars, scale):
    QUERIES |= _module.REGISTRY.queries
    ORACLES |= _module.REGISTRY.oracles
