"""Registered queries over the given tables, each with an equivalent SQL text where one exists."""

from workload.register import QUERIES, SQL

import workload.sources  # noqa: E402,F401
import workload.filters  # noqa: E402,F401
import workload.joins  # noqa: E402,F401
import workload.aggregates  # noqa: E402,F401
import workload.series  # noqa: E402,F401
import workload.scalars  # noqa: E402,F401
import workload.news  # noqa: E402,F401
import workload.risk  # noqa: E402,F401
import workload.models  # noqa: E402,F401
import workload.registry  # noqa: E402,F401
import workload.serving  # noqa: E402,F401
import workload.forecasts  # noqa: E402,F401
import workload.searches  # noqa: E402,F401
import workload.streams  # noqa: E402,F401
import workload.marts  # noqa: E402,F401

__all__ = ["QUERIES", "SQL"]
