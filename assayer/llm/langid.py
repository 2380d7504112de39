"""Language identification in two steps: the family first, then the language within it.

A linear one-against-rest support vector machine picks the family; within a family every pair
of languages has its own linear support vector machine and the most votes win. Features are
shares of hashed letter n-grams of the words, so a text's features are a mean over its words.

Null texts and texts without a letter are ``und`` with score 0, as is everything when nothing
could be learnt. Ties in votes go to the larger margin, then to the name that sorts first.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm.subwords import WordSums, live, subword_buckets
from assayer.llm.tables import labelled_sample

WORDS = re.compile(r"[^\W\d_]+")
BREAKS = re.compile(r"[\W\d_]")

# Families of common languages by code. A code that is not listed is a family of its own.
FAMILIES = {
    **dict.fromkeys(("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"), "germanic"),
    **dict.fromkeys(("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"), "romance"),
    **dict.fromkeys(("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"), "slavic"),
    **dict.fromkeys(("lt", "lv"), "baltic"),
    **dict.fromkeys(("fi", "et", "hu"), "uralic"),
    **dict.fromkeys(("tr", "az", "kk", "uz"), "turkic"),
}


@dataclass(frozen=True)
class LanguageConfig:
    """``max_rows`` per language and ``max_chars`` bound the training sample."""

    n_min: int = 1
    n_max: int = 3
    bits: int = 13
    cost: float = 100_000.0
    passes: int = 15
    max_rows: int = 400
    max_chars: int = 8_000_000


def family_of(lang: str, families: Mapping[str, str] = FAMILIES) -> str:
    return families.get(lang.lower().split("-")[0], f"only {lang}")


def linear_svm(rows: np.ndarray, signs: np.ndarray, cost: float, passes: int) -> np.ndarray:
    """Weights of an L2 machine with hinge loss, by dual coordinate descent; classes weigh alike."""
    n = len(rows)
    share = np.where(signs > 0, (signs > 0).mean(), (signs < 0).mean())
    bound = cost / (2.0 * np.maximum(share, 1e-9) * n)
    weights, dual = np.zeros(rows.shape[1]), np.zeros(n)
    norms = np.maximum((rows * rows).sum(axis=1), 1e-12)
    rng = np.random.default_rng(11)
    for _ in range(passes):
        for i in rng.permutation(n):
            slope = signs[i] * (rows[i] @ weights) - 1.0
            new = min(max(dual[i] - slope / norms[i], 0.0), bound[i])
            if new != dual[i]:
                weights += (new - dual[i]) * signs[i] * rows[i]
                dual[i] = new
    return weights


@dataclass(frozen=True)
class LanguageModel:
    config: LanguageConfig
    members: dict[str, list[str]] = field(default_factory=dict)  # family: languages
    family_rows: dict[str, int] = field(default_factory=dict)
    pair_rows: dict[tuple[str, str], int] = field(default_factory=dict)
    machines: np.ndarray = field(default_factory=lambda: np.zeros((1, 0)))  # bucket x machine
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def word_margins(self, words: list[str]) -> np.ndarray:
        c = self.config
        owner, bucket = subword_buckets(words, c.n_min, c.n_max, c.bits)
        count = np.bincount(owner, minlength=len(words))
        return np.stack(
            [np.bincount(owner, col[bucket], minlength=len(words)) / count for col in self.machines.T], axis=1
        ) if self.machines.shape[1] else np.zeros((len(words), 0))

    def decide(self, margins: np.ndarray) -> tuple[str, float]:
        sure = 1.0
        families = sorted(self.members)
        if len(families) > 1:
            scores = np.array([margins[self.family_rows[f]] for f in families])
            ranked = np.argsort(-scores, kind="stable")
            family = families[ranked[0]]
            sure = 1.0 / (1.0 + np.exp(-np.clip(scores[ranked[0]] - scores[ranked[1]], -50, 50)))
        else:
            family = families[0]
        langs = self.members[family]
        votes, strength = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
        for a, b in combinations(langs, 2):
            m = margins[self.pair_rows[a, b]]
            votes[a if m >= 0 else b] += 1
            strength[a] += m
            strength[b] -= m
        best = min(langs, key=lambda x: (-votes[x], -strength[x], x))
        for a, b in combinations(langs, 2):
            if best in (a, b):
                m = margins[self.pair_rows[a, b]] * (1 if best == a else -1)
                sure = min(sure, 1.0 / (1.0 + np.exp(-np.clip(m, -50, 50))))
        return best, float(sure)

    def predictor(self):
        sums = WordSums(WORDS, BREAKS, self.word_margins, self.machines.shape[1])

        def predict(texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
            total, words = sums(texts)
            margins = total / np.maximum(words, 1)[:, None] + self.bias
            out = [
                self.decide(m) if n and self.members and any(map(str.isalpha, text)) else ("und", 0.0)
                for m, n, text in zip(margins, words, texts)
            ]
            return [lang for lang, _ in out], [score for _, score in out]

        return predict


def train(
    rows: Sequence[tuple[str, str]], config: LanguageConfig = LanguageConfig(),
    families: Mapping[str, str] = FAMILIES,
) -> LanguageModel:
    rows = [(text, lang) for text, lang in rows if any(map(str.isalpha, text))]
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return LanguageModel(config)
    width = 1 << config.bits

    def word_features(words: list[str]) -> np.ndarray:
        owner, bucket = subword_buckets(words, config.n_min, config.n_max, config.bits)
        count = np.bincount(owner, minlength=len(words))
        return np.bincount(owner * width + bucket, 1.0 / count[owner], minlength=len(words) * width).reshape(-1, width)

    features = np.zeros((len(rows), width), np.float32)
    for i, (text, _) in enumerate(rows):
        words, counts = np.unique(np.array(WORDS.findall(text.lower()), object), return_counts=True)
        for at in range(0, len(words), 500):
            part = word_features(words[at : at + 500].tolist())
            features[i] += counts[at : at + 500] @ part
        features[i] /= max(counts.sum(), 1)
    # Centred, so that no machine needs a bias of its own while it is trained.
    centre = features.mean(axis=0)
    features -= centre
    members: dict[str, list[str]] = {}
    for lang in langs:
        members.setdefault(family_of(lang, families), []).append(lang)
    truth = np.array([lang for _, lang in rows], object)
    kin = np.array([family_of(lang, families) for _, lang in rows], object)
    machines, family_rows, pair_rows = [], {}, {}
    if len(members) > 1:
        for family in sorted(members):
            family_rows[family] = len(machines)
            machines.append(linear_svm(features, np.where(kin == family, 1.0, -1.0), config.cost, config.passes))
    for family in sorted(members):
        for a, b in combinations(members[family], 2):
            own = (truth == a) | (truth == b)
            pair_rows[a, b] = len(machines)
            machines.append(linear_svm(features[own], np.where(truth[own] == a, 1.0, -1.0), config.cost, config.passes))
    stacked = np.stack(machines, axis=1) if machines else np.zeros((width, 0))
    return LanguageModel(config, members, family_rows, pair_rows, stacked, -(centre @ stacked))


def fit(
    docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", config: LanguageConfig = LanguageConfig(),
) -> LanguageModel:
    """Learn from a bounded sample of the rows with a language for which ``learn`` holds."""
    known = docs if learn is None else docs.filter(learn)
    return train(labelled_sample(known, id_col, text_col, known, lang_col, config.max_rows, config.max_chars), config)


def language_of(model: LanguageModel, text: Column) -> Column:
    """``struct(lang_pred, score)`` of every whole text; no other column is read."""

    key = uuid.uuid4().hex

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predictor = live(key, model.predictor)
        for batch in batches:
            langs, scores = predictor(batch.tolist())
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    predict.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(predict, T.StructType().add("lang_pred", "string").add("score", "double"))(text)
