"""traitlens: profile analytics as Spark DataFrame operators.

Raw semi-structured profile records go in; a tested star model
(staging view, profile dimension, metrics fact, trait dimension),
data-quality results and reports come out. Every operator is a
composition of Spark built-ins over DataFrames or Columns.
"""

from traitlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
