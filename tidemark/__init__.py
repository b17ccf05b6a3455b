"""tidemark: turn repeated full-state snapshots into history and analytics on Spark.

Every operator takes DataFrames plus column names and returns a DataFrame built
from Spark's own expressions, joins and windows.  Sub-packages:

* ``sources``   – tables, CSV snapshot files, fixtures derived from driver tables
* ``functions`` – column expressions (keys, path parts, rule ladders, sequencing)
* ``operators`` – quality, identity, registry, history, events, rollup, state, expectations
* ``plans``     – the silver/gold call graph and the registered driver queries
* ``streaming`` – bounded (availableNow) ingest with an operations log
"""

from tidemark.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
