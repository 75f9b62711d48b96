"""The queries of the core operators and their SQL."""

from __future__ import annotations

from octoseg.operators.timestamps import p4_found, p4_states
from octoseg.plans import queries as Q
from octoseg.plans import stored  # noqa: F401  adds its queries to those of Q
from octoseg.runtime import Query

QUERIES: dict[str, Query] = {"p4_found": p4_found, "p4_states": p4_states, **Q.QUERIES}
SQL: dict[str, str] = dict(Q.SQL)
