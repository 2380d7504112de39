"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

Every word is the mean of the vectors of its character n-grams and of the word itself, a text
is the mean of its words and of a learnt neutral vector that counts as a fixed number of words, and one
softmax layer reads that mean. The neutral vector keeps texts of few words, whose plain mean is
extreme by chance, near what is usual. An unseen misspelling shares most n-grams with the word that
was learnt. After training the whole model is one number per n-gram bucket, so that scoring is a
sum over the words of a text.

Null and empty texts, and texts without a word, score 0. Very long texts are read whole, in pieces. Scores depend
on the text only, so repeated rows score alike. An empty table gives an empty result. Without
rows of both labels every score is the share of toxic ones, or 0 without any.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm.subwords import WordSums, live, pieces, subword_buckets
from assayer.llm.tables import labelled_sample

WORDS = re.compile(r"\w+")
BREAKS = re.compile(r"\W")


@dataclass(frozen=True)
class ToxicityConfig:
    """``max_rows`` per label and ``max_chars`` bound the training sample."""

    min_texts: int = 5  # rarer words of the sample add nothing to learn from
    neutral_words: float = 10.0  # every text's mean takes in the neutral vector as so many words
    n_min: int = 4
    n_max: int = 6
    bits: int = 17
    dim: int = 4
    epochs: int = 60
    rate: float = 0.1
    floor: float = 0.9997
    scale: float = 100.0
    max_rows: int = 2500
    max_chars: int = 16_000_000
    seed: int = 7


@dataclass(frozen=True)
class ToxicityModel:
    config: ToxicityConfig
    weights: np.ndarray  # one logit per bucket
    bias: float
    neutral: float = 0.0  # the logit of the neutral vector

    def word_logits(self, words: list[str]) -> np.ndarray:
        c = self.config
        owner, bucket = subword_buckets(words, c.n_min, c.n_max, c.bits)
        sums = np.bincount(owner, self.weights[bucket], minlength=len(words))
        return (sums / np.bincount(owner, minlength=len(words)))[:, None]

    def scorer(self):
        sums = WordSums(WORDS, BREAKS, self.word_logits, 1)

        def score(texts: Sequence[str | None]) -> np.ndarray:
            total, words = sums(texts)
            prior = self.config.neutral_words
            logits = (total[:, 0] + prior * self.neutral) / np.maximum(words + prior, 1) + self.bias
            # A text without a word is not toxic, whatever the bias.
            return np.where(words > 0, 1.0 / (1.0 + np.exp(-np.clip(logits, -500, 500))), 0.0)

        return score


def _sums_by(values: np.ndarray, order: np.ndarray | slice, starts: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``values`` summed by key; ``order`` sorts by key, ``starts`` begins each run."""
    out = np.zeros((size, values.shape[1]), values.dtype)
    if len(starts):
        out[keys] = np.add.reduceat(values[order], starts, axis=0)
    return out


def _runs(keys: np.ndarray) -> tuple[np.ndarray | slice, np.ndarray, np.ndarray]:
    """Order, starts and keys of the runs; keys that come sorted need no copy of what they order."""
    if (keys[1:] >= keys[:-1]).all():
        order = slice(None)
    else:
        order = np.argsort(keys, kind="stable").astype(np.int32)
    found, starts = np.unique(keys[order], return_index=True)
    return order, starts, found


def train(rows: Sequence[tuple[str, int]], config: ToxicityConfig = ToxicityConfig()) -> ToxicityModel:
    """Fit embeddings and softmax together by Adam on the whole sample."""
    labels = np.array([1 if label else 0 for _, label in rows], np.int64)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.0
        logit = -30.0 if share == 0 else 30.0
        return ToxicityModel(config, np.zeros(1 << config.bits, np.float64), logit)
    places: dict[str, int] = {}
    doc_of, word_of, share_of = [], [], []
    # Texts are cut twice, piece by piece: the words of the whole sample would take ten times its memory on the driver.
    seen: Counter[str] = Counter()
    for text, _ in rows:
        seen.update(set().union(*map(WORDS.findall, pieces(text.lower(), BREAKS))))
    often = {w for w, n in seen.items() if n >= config.min_texts}
    del seen
    sizes = np.zeros((len(rows), 1), np.float32)
    for doc, (text, _) in enumerate(rows):
        counted: Counter[str] = Counter()
        size = 0
        for part in pieces(text.lower(), BREAKS):
            words = WORDS.findall(part)
            size += len(words)
            counted.update(w for w in words if w in often)
        ids = np.fromiter((places.setdefault(w, len(places)) for w in counted), np.int32, len(counted))
        order = np.argsort(ids)
        doc_of.append(np.full(len(ids), doc, np.int32))
        word_of.append(ids[order])
        times = np.fromiter(counted.values(), np.int64, len(counted))[order]
        share_of.append((times / max(size + config.neutral_words, 1)).astype(np.float32))
        sizes[doc] = size
    doc, word = np.concatenate(doc_of), np.concatenate(word_of)
    share = np.concatenate(share_of)[:, None]
    del doc_of, word_of, share_of, often
    prior = np.float32(config.neutral_words) / np.maximum(sizes + np.float32(config.neutral_words), 1)
    owner, bucket = subword_buckets(list(places), config.n_min, config.n_max, config.bits)
    used, bucket = np.unique(bucket, return_inverse=True)
    by_word, by_bucket = _runs(word), _runs(bucket)
    by_owner, by_doc = _runs(owner), _runs(doc)
    per_word = np.bincount(owner, minlength=len(places)).astype(np.float32)[:, None]
    rng = np.random.default_rng(config.seed)
    params = [
        rng.uniform(-1, 1, (len(used), config.dim)).astype(np.float32) / 100,
        rng.uniform(-1, 1, (config.dim, 2)).astype(np.float32) / config.dim,
        np.zeros((1, 2), np.float32),
        np.zeros((1, config.dim), np.float32),
    ]
    # Adam with a floor under its scale: an n-gram whose gradient is below the floor, as that of
    # rare ones is by chance, moves in proportion to it and stays small.
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    floors: list[float] = []
    truth = np.eye(2, dtype=np.float32)[labels]
    # Both labels weigh alike, whatever their shares in the sample.
    weigh = (0.5 / np.bincount(labels, minlength=2)).astype(np.float32)[labels][:, None]
    for step in range(1, config.epochs + 1):
        table, layer, bias, neutral = params
        words = _sums_by(table[bucket], *by_owner, len(places)) / per_word
        means = _sums_by(words[word] * share, *by_doc, len(rows)) + prior * neutral
        logits = config.scale * means @ layer + bias
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        error = (odds / odds.sum(axis=1, keepdims=True) - truth) * weigh
        to_means = config.scale * error @ layer.T
        to_words = _sums_by(to_means[doc] * share, *by_word, len(places)) / per_word
        grads = [
            _sums_by(to_words[owner], *by_bucket, len(used)),
            config.scale * means.T @ error,
            error.sum(axis=0, keepdims=True),
            (prior * to_means).sum(axis=0, keepdims=True),
        ]
        floors = floors or [float(np.quantile(np.abs(g), q)) for g, q in zip(grads, (config.floor, 0, 0, 0))]
        for p, g, m, v, floor in zip(params, grads, first, second, floors):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= config.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + floor + 1e-12)
    table, layer, bias, neutral = params
    weights = np.zeros(1 << config.bits, np.float32)
    weights[used] = config.scale * (table @ (layer[:, 1] - layer[:, 0]))
    apart = config.scale * (layer[:, 1] - layer[:, 0])
    return ToxicityModel(config, weights, float(bias[0, 1] - bias[0, 0]), float(neutral[0] @ apart))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", learn: Column | None = None, config: ToxicityConfig = ToxicityConfig(),
) -> ToxicityModel:
    """Learn from a bounded sample of the rows of ``labels`` for which ``learn`` holds."""
    known = labels if learn is None else labels.filter(learn)
    return train(
        labelled_sample(docs, id_col, text_col, known, label_col, config.max_rows, config.max_chars), config
    )


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Score from 0 to 1 of every whole text; no other column is read."""

    key = uuid.uuid4().hex

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = live(key, model.scorer)
        for batch in batches:
            yield pd.Series(scorer(batch.tolist()))

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(score, T.DoubleType())(text)
