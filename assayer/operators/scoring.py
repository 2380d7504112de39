"""Scoring with any user-supplied model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from assayer.labels import LABELS

Scorer = Callable[[Sequence[str]], np.ndarray]


def batch_former(
    text_col: str, batch_size: int, max_padded: int | None
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Turns a task's Arrow batches into model batches of texts of like lengths.

    Rows are taken longest first, up to ``batch_size`` and, with ``max_padded``, until rows times the
    longest text would exceed that many characters (a text longer than that is a batch alone). What
    does not fill a batch waits for the next Arrow batch, so only a task's last batch may be short.
    """

    # Nested, so that it is shipped by value and workers need not have this package.
    def form(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: pd.DataFrame | None = None
        for frame in frames:
            rows = frame if waiting is None else pd.concat([waiting, frame], ignore_index=True)
            sizes = rows[text_col].map(lambda text: 0 if text is None else len(text)).to_numpy()
            order = np.argsort(-sizes, kind="stable")
            rows, sizes = rows.iloc[order], sizes[order]
            at = 0
            while at < len(rows):
                fit = batch_size
                if max_padded is not None:
                    fit = max(1, min(fit, max_padded // max(1, int(sizes[at]))))
                if len(rows) - at < fit:
                    break
                yield rows.iloc[at : at + fit].reset_index(drop=True)
                at += fit
            waiting = rows.iloc[at:].reset_index(drop=True)
        if waiting is not None and len(waiting):
            yield waiting

    return form


def batched_scorer(
    docs: DataFrame,
    text_col: str,
    load_scorer: Callable[[], Scorer],
    batch_size: int = 32,
    labels: Sequence[str] = LABELS,
    max_padded: int | None = None,
) -> DataFrame:
    """Add ``predicted_category``: batch to scores to highest score (ties: lowest label id).

    ``load_scorer`` runs once per task and returns a function from a batch of texts to a
    ``len(batch) x len(labels)`` array. Batches are as :func:`batch_former` makes them, so padding to
    the longest text of a batch costs little; a task holds one Arrow batch and one model
    batch. The text column itself is not sent back.
    """
    kept = [f for f in docs.schema.fields if f.name != text_col]
    schema = T.StructType([*kept, T.StructField("predicted_category", T.StringType())])
    names = np.array(labels, dtype=object)
    form = batch_former(text_col, batch_size, max_padded)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = load_scorer()
        done: list[pd.DataFrame] = []
        rows = 0
        for batch in form(frames):
            texts = batch.pop(text_col).tolist()
            batch["predicted_category"] = names[np.asarray(scorer(texts)).argmax(axis=1)]
            done.append(batch)
            rows += len(batch)
            # Small frames travel together.
            if rows >= 10_000:
                yield pd.concat(done, ignore_index=True)
                done, rows = [], 0
        if done:
            yield pd.concat(done, ignore_index=True)

    return docs.select(*[f.name for f in kept], text_col).mapInPandas(score, schema)
