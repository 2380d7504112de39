"""Audit, featurise, classify and evaluate tables of labelled text records on Spark.

Every public function takes and returns DataFrames or Columns, so plans stay lazy
until the caller writes or reads the result.
"""

from assayer.labels import LABELS, label_dim

__all__ = ["LABELS", "label_dim"]
