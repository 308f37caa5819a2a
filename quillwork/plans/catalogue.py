"""Every query over the driver's tables, with its SQL. Keys begin with the id of the operator that they show."""

from __future__ import annotations

from . import basics, evaluation, history, relations, stores, texts

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _module in (basics, history, relations, texts, evaluation, stores):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
