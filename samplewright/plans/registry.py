"""Every query of the library over the driver's tables, with its SQL."""

from __future__ import annotations

from samplewright.plans import flows, parameters, reads, reports, sheets, streams
from samplewright.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "flows", "parameters", "reads", "reports", "sheets", "streams"]
