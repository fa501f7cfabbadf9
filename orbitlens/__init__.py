"""orbitlens: telemetry time-series analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function that processes all
series of a long telemetry table in one distributed plan.  The canonical
table is::

    metric STRING, <tag columns> STRING, ts TIMESTAMP_NTZ (UTC), value DOUBLE

A *series* is identified by ``metric`` plus the tag columns (``keys``).
"""

from orbitlens.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
