"""Line dedup as the queries run it."""

import random

from assayer.llm import linededup, near_lines


def kept(spark, lines):
    """The lines that stay of documents of one line each."""
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    out = linededup.dedup_lines(docs, config=linededup.WHOLE).collect()
    return [r.text for r in sorted(out, key=lambda r: r.doc_id) if r.text]


def test_copies_may_differ_in_signs_and_white_space(spark):
    first = ["Read more", "the quick brown fox jumps over it", "---", "\u0915\u093f \u0932", "\u0915\u093e \u0932"]
    copies = ["Read more!", "\u00abread\u00a0more\u00bb", "The quick, brown fox\tjumps over it.", " --- "]
    assert kept(spark, [*first, *copies, "***"]) == [*first, "***"]


def similar(a, b):
    """Edit similarity of at least 0.8, by the whole table of distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= int(max(len(a), len(b)) * 0.2 + 1e-9)


def changed_word(rng, line):
    words = line.split()
    at = rng.randrange(len(words))
    words[at] = "".join(rng.choice("bcdfgklmpr") for _ in words[at])
    return " ".join(words)


def test_one_changed_word_is_found(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeioustnrlm") for _ in range(rng.randint(3, 8)))
    first = [" ".join(word() for _ in range(n)) for n in (10, 15, 20, 30, 50) for _ in range(40)]
    copies = [changed_word(rng, line) for line in first]
    assert all(map(similar, first, copies))
    left = kept(spark, first + copies)
    assert left[: len(first)] == first
    assert len(left) - len(first) <= 0.05 * len(copies)


def test_short_lines_by_brute_force(spark):
    rng = random.Random(4)
    first = ["Share this on Facebook", "abcd", "abcde", "read more of it"]
    first += ["".join(rng.choice("abc de") for _ in range(rng.randint(3, 39))).strip() for _ in range(60)]
    lines = list(dict.fromkeys(" ".join(x.split()).lower() for x in first if x.split()))
    for line in list(lines):
        edited = list(line)
        for _ in range(rng.randint(1, 10)):
            at = rng.randrange(len(edited))
            edited[at : at + 1] = rng.choice([[], ["x"], ["y", edited[at]]])
            edited = edited or ["z"]
        lines.append(" ".join("".join(edited).split()) or "z")
    lines = list(dict.fromkeys(lines))
    root = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            if min(len(lines[i]), len(lines[j])) < near_lines.SHORT and similar(lines[i], lines[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert kept(spark, lines) == [x for i, x in enumerate(lines) if root[i] == i]
    assert 10 < len({r for r in root}) < len(lines) - 10
    assert kept(spark, ["Share this on Facebook", "Share this on Facebooks."]) == ["Share this on Facebook"]
