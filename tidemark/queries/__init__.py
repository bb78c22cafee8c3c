"""Every operator bound to the test tables, each beside an independent SQL statement."""

from . import (aggregates, cleansing, deployments, governance, joins, reports, scalars, scans, sinks, source_jobs,
               streams, views, windows)  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
