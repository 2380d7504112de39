"""The words of the training sample are not held on the driver all at once."""

import tracemalloc
from dataclasses import replace

import numpy as np

from assayer.llm import toxicity


def test_training_holds_no_list_of_all_words():
    rng = np.random.default_rng(3)
    words = np.array([f"word{i}" for i in range(300)])
    rows = [(" ".join(rng.choice(words, 1500)) + (" vile" if i % 2 else ""), i % 2) for i in range(400)]
    chars = sum(len(text) for text, _ in rows)
    tracemalloc.start()
    model = toxicity.train(rows, replace(toxicity.ToxicityConfig(), epochs=1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * chars
    assert len(model.weights) == 1 << model.config.bits


def test_sums_of_sorted_keys_equal_those_of_any_order():
    rng = np.random.default_rng(4)
    keys, values = rng.integers(0, 9, 200), rng.integers(0, 50, (200, 3)).astype(np.float64)
    expected = np.zeros((9, 3))
    np.add.at(expected, keys, values)
    order = np.argsort(keys)
    for k, v in ((keys, values), (keys[order], values[order]), (keys[:0], values[:0])):
        want = expected if len(k) else np.zeros((9, 3))
        assert (toxicity._sums_by(v, *toxicity._runs(k), 9) == want).all()
