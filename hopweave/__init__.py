"""hopweave: Spark-native builders for behavioural datasets over transfer ledgers.

Every operator is a plain function ``DataFrame -> DataFrame`` made of Spark's
own joins, windows and aggregates.  Sub-packages:

* ``functions``  shared column expressions (addresses, stable hashes, calendar labels)
* ``sources``    readers for label files and the stand-in ledger tables
* ``operators``  labels, accounts, graph, daily features, shrink/profile, windows, publish
* ``plans``      pipelines that chain operators, plus the query registry
* ``streaming``  incremental (micro-batch) drivers over the batch operators
"""

from hopweave.session import get_session

__all__ = ["get_session"]
