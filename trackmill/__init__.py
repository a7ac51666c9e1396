"""trackmill: cleaning, ranking, trajectory, stream and tree-model jobs on Spark DataFrames."""

from trackmill.session import build_session, checkpointed, new_shared_dir

__all__ = ["build_session", "checkpointed", "new_shared_dir"]
