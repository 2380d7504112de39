"""Line dedup as the query and the pipeline run it, by brute force over all pairs of lines."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from assayer.llm import linededup

MASK = (1 << 64) - 1
EDGES = [64 * i // 5 for i in range(6)]


def norm(line):
    letters = " ".join(re.findall(r"[^\W_]+", line.lower()))
    return letters or " ".join(line.lower().split())


def simhash(line):
    hashes = {xxhash.xxh64_intdigest(w.encode(), 42) for w in line.split()}
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def linked(a, b):
    """Two blocks alike, at most 12 bits apart, edit similarity of at least 0.8."""
    if min(len(a.split()), len(b.split())) < 5:
        return False
    apart = simhash(a) ^ simhash(b)
    alike = sum(not (apart >> x) & ((1 << (y - x)) - 1) for x, y in zip(EDGES, EDGES[1:]))
    return alike >= 2 and apart.bit_count() <= 12 and distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)


def expected(rows):
    """(id, text) of rows with different (id, text), by components over all pairs."""
    order = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or 0))
    forms = list(dict.fromkeys(norm(x) for _, t in order for x in t.split("\n") if x.strip(" \t\r")))
    root = {f: f for f in forms}
    for i, a in enumerate(forms):
        for b in forms[:i]:
            if root[a] != root[b] and linked(a, b):
                old, new = root[a], root[b]
                root = {f: new if r == old else r for f, r in root.items()}
    seen, out = set(), {}
    for i, text in order:
        kept = []
        for line in text.split("\n"):
            key = root[norm(line)] if line.strip(" \t\r") else None
            if key is None or key not in seen:
                kept.append(line)
            seen.add(key)
        out[i] = "\n".join(kept)
    return out | {i: None for i, t in rows if t is None}


def some_rows(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioustnrlmk") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 3, 5, 8, 20, 40, 60, 90, 120) for _ in range(3)]
    rows = [(None, "Of no id\n" + base[0]), (0, ""), (1, None), (2, " \n\t\n---"), (3, "--- \n-- -")]
    for i in range(4, 60):
        lines = []
        for _ in range(rng.randint(1, 4)):
            line = rng.choice(base).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                line[rng.randrange(len(line))] = rng.choice(words)
            if rng.random() < 0.2 and len(line) > 9:
                del line[rng.randrange(len(line))]
            text = " ".join(line)
            lines.append(rng.choice([text, text.title() + "!", text.replace(" ", ", ", 1), ""]))
        rows.append((i, "\n".join(lines)))
    return rows


def test_query_configuration_by_brute_force(spark):
    rows = some_rows(5)
    docs = spark.createDataFrame([(i, t, "x", 2) for i, t in rows], "doc_id long, text string, line string, _line int")
    out = linededup.dedup_lines(docs.repartition(5), config=linededup.SIMHASH)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    want = expected(rows)
    assert got == want
    changed = sum(want[i] != t for i, t in rows)
    assert changed > 20
    assert linededup.dedup_lines(docs.limit(0), config=linededup.SIMHASH).count() == 0


def test_repeated_rows_of_one_line_keep_one_line(spark):
    line = "one line that every copy of this row holds in full"
    docs = spark.range(40).select(F.lit(None).cast("long").alias("doc_id"), F.lit(line).alias("text"))
    out = linededup.dedup_lines(docs, config=linededup.SIMHASH, removed_col="gone").collect()
    assert sorted(r.text for r in out) == [""] * 39 + [line]
    assert sorted(r.gone for r in out) == [0] + [1] * 39


def test_words_prove_no_more_than_characters(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 7)))
    pairs = []
    for _ in range(250):
        a = [word() for _ in range(rng.randint(1, 60))]
        b = [x for x in a if rng.random() > 0.04] or ["x"]
        b = [word() if rng.random() < rng.choice([0, 0.1, 0.3]) else x for x in b]
        pairs.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    coded = df.select("a", "b", linededup._coded(F.col("a")).alias("x"), linededup._coded(F.col("b")).alias("y"))
    got = coded.select("a", "b", linededup._similar_coded("x", "y", linededup.SIMHASH).alias("near")).collect()
    assert all(r.near == (distance(r.a, r.b) <= int(max(len(r.a), len(r.b)) * 0.2 + 1e-9)) for r in got)
    assert 30 < sum(r.near for r in got) < 220
