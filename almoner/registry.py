"""Every query of the library's own operators, and the SQL that each is held against."""

from __future__ import annotations

from almoner.plans import entities, filings, profiles, relations, reports, scalars, storage  # noqa: F401
from almoner.plans.register import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
