"""Every operator as a query over the test tables, with its SQL equivalent."""

from cityloom.gallery import dashboard, figures, jobs, models, relations, scans, shaping  # noqa: F401 - they register
from cityloom.gallery.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
