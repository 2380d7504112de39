"""A Python worker drops what earlier stages used before it makes something new."""

import sys

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm import subwords


def _kept_after(spark, *keys):
    """The keys that the worker of a single task holds once it has asked for ``keys``."""
    live = subwords.live

    def ask(batch: pd.Series) -> pd.Series:
        for key in keys:
            live(key, object)
        kept = sys.modules["_assayer_live"].kept
        return pd.Series([",".join(sorted(kept))] * len(batch))

    ask.__annotations__ = {"batch": pd.Series, "return": pd.Series}
    return spark.range(0, 1, 1, 1).select(F.pandas_udf(ask, T.StringType())("id")).first()[0].split(",")


def test_scorers_of_earlier_tasks_go_and_those_of_one_task_stay(spark):
    assert _kept_after(spark, "live-a", "live-b") == ["live-a", "live-b"]
    for i in range(12):  # whichever worker takes the task, nothing of an earlier one is left
        assert _kept_after(spark, f"live-{i}", f"live-{i}x") == sorted([f"live-{i}", f"live-{i}x"])


def test_a_scorer_is_made_once_outside_of_tasks():
    made = []
    for _ in range(3):
        subwords.live("live-plain", lambda: made.append(1) or made)
    assert made == [1]
