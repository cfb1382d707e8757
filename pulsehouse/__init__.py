"""pulsehouse: bronze/silver/gold analytics over device and session data on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (batch and streaming
share it); streaming wrappers only add a source, a trigger and a sink.
"""

from pulsehouse.session import build_session, scratch_dir, checkpoint_root

__all__ = ["build_session", "scratch_dir", "checkpoint_root"]
