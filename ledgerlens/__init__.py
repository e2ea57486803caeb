"""ledgerlens: housing-sales and incident-stream analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame / Structured Streaming API, so Catalyst plans it and the same code
runs on a laptop or a cluster.  See README.md for the map of operators.
"""

from ledgerlens.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
