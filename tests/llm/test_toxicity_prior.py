"""Texts of few words, texts that repeat one word, and the score as explicit averages."""

import random

import numpy as np
import pytest

from assayer.llm import toxicity
from assayer.llm.subwords import subword_buckets


@pytest.fixture(scope="module")
def model():
    rng = random.Random(9)
    plain = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(1500):
        words = [rng.choice(plain) for _ in range(rng.randint(2, 80))]
        for _ in range(3 if i % 4 == 0 else 0):
            words.insert(rng.randrange(len(words)), rng.choice(("qwurzzle", "vuxxo", "zzyqqat")))
        rows.append((" ".join(words), int(i % 4 == 0)))
    return toxicity.train(rows[:1200]), rows, plain


def test_few_words_and_repeated_words_stay_clean(model):
    fitted, rows, plain = model
    score = fitted.scorer()
    short = [" ".join(plain[i : i + n]) for n in (1, 2, 3) for i in range(0, 400, 5)]
    assert (score(short) >= 0.5).mean() < 0.02
    assert (score([f"{w} " * 30 for w in plain[::7]]) >= 0.5).mean() < 0.05
    held = rows[1200:]
    assert ((score([t for t, _ in held]) >= 0.5) == np.array([bool(y) for _, y in held])).mean() > 0.9
    assert score([None, "", " .. "]).tolist() == [0.0, 0.0, 0.0]


def test_score_is_the_average_the_method_names(model):
    fitted, rows, _ = model
    c = fitted.config
    for text, _ in rows[:20]:
        words = text.split()
        total = c.neutral_words * fitted.neutral
        for word in words:
            _, buckets = subword_buckets([word], c.n_min, c.n_max, c.bits)
            total += float(np.mean([fitted.weights[b] for b in buckets]))
        logit = total / (len(words) + c.neutral_words) + fitted.bias
        assert fitted.scorer()([text])[0] == pytest.approx(1 / (1 + np.exp(-logit)), rel=1e-4, abs=1e-9)
