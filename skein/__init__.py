"""skein: route, graph, model and recommender analytics on plain Spark DataFrames.

Every public operator takes DataFrames (or Columns) and returns DataFrames (or Columns).
Nothing collects rows to the driver; iterative operators cut lineage with reliable
checkpoints under the session's ``spark.checkpoint.dir``.
"""

from skein.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
