"""meterwise: trip-record analytics layers on Spark.

Raw -> Cleaned -> Fact/Dim -> Mart, expressed with the public DataFrame API so
that Catalyst and adaptive execution do the planning.  Subpackages:

* ``functions``  column-expression helpers (time features, guarded ratios,
  money casts, deterministic ids)
* ``sources``    readers, month discovery, partitioned writers, catalog DDL
* ``operators``  cleaning, fact, dimensions, marts, cumulative marts, daily
  partials, skew and quality reports
* ``plans``      layer runners and the trip-shaped fixture views
* ``streaming``  intentionally empty (the workload is batch only)
"""

from meterwise.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
