"""Embedding whitening, WARC archives and ranked lexical search against plain Python, on small rows."""

import base64
import gzip
import hashlib
import math
import os
import re
from collections import Counter

import numpy as np
import pytest

from assayer.llm import lexical, warc, whitening
from assayer.llm.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


# --- whitening ----------------------------------------------------------------------------------


def _matrices():
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 6, 24):
        a = rng.standard_normal((n, n))
        q = np.linalg.qr(a)[0]
        b = rng.standard_normal((n, 2))
        yield a @ a.T
        yield np.eye(n) * 3
        yield q @ np.diag([5.0] * min(3, n) + [1.0] * (n - min(3, n))) @ q.T  # equal eigenvalues
        yield q @ np.diag(1 + 1e-9 * np.arange(n)) @ q.T  # hardly apart
        yield b @ b.T  # rank 2
        yield np.zeros((n, n))


@pytest.mark.parametrize("v", list(_matrices()), ids=str)
def test_spectrum_slicing_finds_the_leading_eigenpairs(v):
    v = (v + v.T) / 2
    want = np.linalg.eigvalsh(v)[::-1]
    for shift in np.random.default_rng(len(v)).standard_normal(8) * 3:
        assert whitening.eigenvalues_above(v, shift) == (want > shift).sum()
    values, vectors = whitening.leading_eigenpairs(v, 4)
    size = max(1e-300, np.abs(want).max())
    expected = want[:4][want[:4] > 1e-10 * size]
    assert np.allclose(values, expected, rtol=1e-11) and len(values) == len(expected)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-12
    assert np.abs(v @ vectors - vectors * values).max(initial=0) < 1e-9 * size


def test_a_wrong_number_is_not_certified():
    with pytest.raises(ArithmeticError):
        whitening.certify(np.diag([3.0, 2.0, 1.0]), 2.0, 1, 1, 1e-12)


def _expected_whitening(rows):
    """By explicit definition: ``{(id, component): (n, deviation, |whitened|, explained)}`` of one length."""
    ints = [(i, [math.floor(256 * c) for c in v]) for i, v in rows]
    fit = [list(v) for v in sorted({tuple(v) for _, v in ints})]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    apart = np.array([[x - s / n for x, s in zip(v, sums)] for v in fit])
    cov = apart.T @ apart / n
    values, vectors = np.linalg.eigh(cov)
    out = {}
    for i, v in ints:
        deviation = sum((n * x - s) ** 2 for x, s in zip(v, sums))
        for c in range(min(4, len(sums))):
            e, q = values[-1 - c], vectors[:, -1 - c]
            if e > 1e-9 * values[-1]:
                z = sum((x - s / n) * w for x, s, w in zip(v, sums, q)) / math.sqrt(e)
                out.setdefault((i, c + 1), []).append((n, deviation, abs(z), e / np.trace(cov)))
    return out


def _same_whitening(got, want):
    found = {}
    for r in got:
        found.setdefault((r[0], r["component"]), []).append((r["n"], r["deviation"], abs(r["whitened"]), r["explained"]))
        assert r["identity_error"] < 1e-9
    assert found.keys() == want.keys()
    for key in want:
        assert len(found[key]) == len(want[key])
        for a, b in zip(sorted(found[key]), sorted(want[key])):
            assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9, abs=1e-11) and a[3] == pytest.approx(b[3], rel=1e-9)


def test_whitening_equals_its_definition(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in df.collect()]
    _same_whitening(QUERIES["op11_embedding_whitening"](spark, SF_DIR).collect(), _expected_whitening(rows))


def test_whitening_of_odd_rows(spark):
    plain = [(1, [1.0, 2.0, 0.5]), (2, [1.0, 2.0, 0.5]), (3, [5.0, 1.0, 0.25]), (None, [2.0, 2.0, -0.001]), (9, [0.0, 4.0, 1.0])]
    plain += [(4, [1.0, 2.0, 0.5])] * 3  # one row three times
    other = [(21, [3.0]), (22, [4.0]), (23, [4.0])]
    odd = [(5, None), (6, [float("nan"), 1.0, 2.0]), (7, []), (8, [1e300, 0.0, 0.0]), (10, [None, 1.0, 1.0]), (11, [float("inf"), 1.0, 1.0]), (12, [1.0, 1.0])]
    schema = "vec_id bigint, embedding array<double>, x string, id int, component string"
    df = spark.createDataFrame([(*r, "a", 1, "b") for r in plain + other + odd], schema)
    want = _expected_whitening(plain)
    want.update(_expected_whitening(other))
    _same_whitening(whitening.whiten(df).collect(), want)  # one vector alone ([1, 1], []) has no components
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.filter("vec_id = 1")).collect() == []
    wide = spark.createDataFrame([(1, [2.0**50, 0.0]), (2, [0.0, 1.0]), (3, [-(2.0**50), 7.0])], "vec_id bigint, embedding array<double>")
    assert {r["deviation"] for r in whitening.whiten(wide).collect() if r["vec_id"] != 2} == {None}  # beyond a long


# --- WARC ---------------------------------------------------------------------------------------

ROWS = [
    (1, "u1", "hello"), (2, "u2", "hello"), (None, "u3", "hello"), (4, None, None), (5, "u5", ""),
    (6, "a\r\nb ü", "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n\r\n"),
    (7, "u7", "é" * 50_000), (7, "u7", "é" * 50_000), (7, "u7", "é" * 50_000), (7, "u6", "é" * 50_000), (8, "u8", "\r\n" * 5),
    (None, None, "z"), (None, None, "z"),
]
CONFIG = warc.WarcConfig(segment_bytes=1_001, chunk_bytes=77)


def _expected_archive(rows, least=0):
    out, groups = [], {}
    for i, url, html in rows:
        groups.setdefault((html or "").encode(), []).append((i, url))
    for payload, same in groups.items():
        best = max(same, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
        answered = False
        for i, url in same:
            response = len(payload) < least or ((i, url) == best and not answered)
            answered |= response
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            out.append((i, len(payload), digest, "response" if response else "revisit", None if response else best[0], payload))
    return sorted(out, key=str)


def _read(spark, folder, **options):
    def number(value):
        return value if value is None else int(value)

    rows = warc.read_archives(spark, folder, **options).collect()
    return sorted(
        (
            (number(r["id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"]), bytes(r["payload"]))
            for r in rows
        ),
        key=str,
    )


@pytest.mark.parametrize("least", [0, 5, 100])
def test_archives_give_every_row_back(spark, least):
    df = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "page_id bigint, url string, html string, n int, digest string")
    config = warc.WarcConfig(1_001, 77, least)
    folder = warc.write_archives(df.repartition(3), config=config)
    assert _read(spark, folder) == _expected_archive(ROWS, least)
    urls = {r["url"] for r in warc.read_archives(spark, folder, payload=False).collect()}
    assert urls == {"u1", "u2", "u3", None, "u5", "a%0D%0Ab ü", "u7", "u6", "u8"}
    empty = warc.write_archives(df.limit(0))
    assert warc.read_archives(spark, empty).collect() == []


def _archive(tmp_path, *records):
    folder = tmp_path / "archive"
    folder.mkdir()
    for n, group in enumerate(records):
        with gzip.open(folder / f"{n}.warc.gz", "wb") as f:
            for fields, block in group:
                head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
                f.write(f"WARC/1.0\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n")
    return f"file://{folder}"


def _segments(block, cuts):
    parts = [block[a:b] for a, b in zip([0, *cuts], [*cuts, len(block)])]
    out = [({"WARC-Type": "response", "WARC-Record-ID": "<urn:a>", "X-Row-ID": "3", "WARC-Segment-Number": 1}, parts[0])]
    for n, part in enumerate(parts[1:], 2):
        fields = {"warc-type": "continuation", "WARC-Record-ID": f"<urn:{n}>", "WARC-Segment-Origin-ID": "<urn:a>", "WARC-Segment-Number": n}
        out.append((fields | ({"WARC-Segment-Total-Length": len(block)} if n == len(parts) else {}), part))
    return out


BLOCK = b"HTTP/1.1 200 OK\r\ntransfer-encoding: Chunked\r\n\r\n3;note=1\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: x\r\n\r\n"


def test_segments_of_other_writers_in_any_order_and_file(spark, tmp_path):
    a, b, c, d = _segments(BLOCK, [1, 40, 60])
    plain = ({"WARC-Type": "response", "WARC-Record-ID": "<urn:p>"}, b"HTTP/1.1 200 OK\r\n\r\n\xff\xfe\r\n\r\n")
    folder = _archive(tmp_path, [d, plain], [b], [c, a])
    got = {r["id"]: bytes(r["payload"]) for r in warc.read_archives(spark, folder).collect()}
    assert got == {"3": b"abc0123456789", None: b"\xff\xfe\r\n\r\n"}


@pytest.mark.parametrize(
    "spoil, message",
    [
        (lambda s: [s[0], s[2]], "not 1 to 2"),
        (lambda s: [s[0], s[1], s[1], s[2]], "not 1 to 4"),
        (lambda s: s[:2], "stated"),
        (lambda s: [s[0], s[1], (s[2][0] | {"WARC-Segment-Total-Length": 5}, s[2][1])], "5 stated"),
        (lambda s: [(s[0][0] | {"WARC-Payload-Digest": "sha1:AAAA"}, s[0][1]), *s[1:]], "digest"),
        (lambda s: [({"WARC-Type": "response", "WARC-Record-ID": "<urn:q>"}, BLOCK[:70])], "cut short"),
        (lambda s: [({"WARC-Type": "revisit", "WARC-Record-ID": "<urn:q>", "WARC-Refers-To": "<urn:none>"}, b"")], "absent"),
    ],
)
def test_broken_records_are_told(spark, tmp_path, spoil, message):
    folder = _archive(tmp_path, spoil(_segments(BLOCK, [20, 60])))
    assert message in warc.read_archives(spark, folder, strict=False).collect()[0]["problem"]
    with pytest.raises(Exception, match=re.escape(message)):
        warc.read_archives(spark, folder).collect()


def test_a_cut_archive_fails(spark, tmp_path):
    folder = _archive(tmp_path, [])
    with gzip.open(os.path.join(folder.removeprefix("file://"), "0.warc.gz"), "wb") as f:
        f.write(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 90\r\n\r\nabc\r\n\r\n")
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_archives(spark, folder).collect()


# --- ranked search ------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def _expected_ranks(docs, items, k):
    counted = [(i, Counter(_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    total, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item in sorted({i for i, _ in items}, key=str):
        wanted = {t for i, text in items if i == item for t in _terms(text)}
        scored = []
        for i, c in counted:
            m = 10 + (90 * sum(c.values()) * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in wanted & c.keys()
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return out


DOCS = [
    (1, "the red fox, the RED Fox"), (2, "a fox and a hen; ünïcode Ünïcode"), (3, None), (4, ""), (5, "... !!"), (6, "a fox and a hen"),
    (6, "a fox and a hen"), (6, "something else"), (None, "a fox and a hen"), (None, "hen hen hen"), (10, "word " * 30_000 + "fox"),
    (11, "don't x_y 3.14 e-mail"), (12, "日本 語　全角 hen"), (13, "İstanbul ſ K hen"),
]
ITEMS = [(1, "fox"), (2, "hen AND fox fox"), (3, None), (4, "?!"), (5, "absent"), (6, "ünïcode 日本 t y 14"), (7, "hen"), (7, "red"), (None, "word"), (1, "fox")]


@pytest.mark.parametrize("config", [lexical.SearchConfig(), lexical.SearchConfig(3, 7, 1, 25), lexical.SearchConfig(100, 10_000, 2)])
def test_ranks_equal_brute_force(spark, config):
    docs = spark.createDataFrame([(*r, "x", 0) for r in DOCS], "doc_id bigint, text string, item_id string, score int").repartition(2)
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id int, text string, doc_id string")
    got = lexical.ranked_search(docs, items, 4, config=config).collect()
    assert sorted(map(tuple, got), key=str) == sorted(_expected_ranks(DOCS, ITEMS, 4), key=str)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.filter("doc_id in (3, 4, 5)"), items)):
        assert lexical.ranked_search(d, i, 4).collect() == []


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([("b", "fox"), ("a", "fox"), (None, "fox")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "fox")], "item_id string, text string")
    got = lexical.ranked_search(docs, items, 3).collect()
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["rank"])] == ["a", "b", None]


def test_trees_prune_and_lose_nothing():
    """Documents in far groups: whole subtrees are passed over, with the same result as a scan."""
    rng = np.random.default_rng(3)
    rows = []
    for group in range(40):
        own = np.arange(group * 20, group * 20 + 20)
        rows += [dict(zip(rng.choice(own, 12, replace=False).tolist(), rng.integers(100_000, 999_999, 12).tolist())) for _ in range(50)]
    starts = np.cumsum([0, *map(len, rows)])
    terms = np.array([t for r in rows for t in r])
    values = np.array([v for r in rows for v in r.values()])
    tree = lexical.BallTree(starts, terms, values, 800, 16)
    for group in (0, 17, 39):
        query = np.zeros(800, np.int64)
        query[group * 20 : group * 20 + 8] = rng.integers(1, 9_000, 8)
        scores = [(sum(v * int(query[t]) for t, v in r.items()), i) for i, r in enumerate(rows)]
        want = sorted((s, i) for s, i in scores if s > 0)
        before = tree.scanned
        assert tree.top(query, 10) == sorted(want, key=lambda x: (-x[0], x[1]))[:10]
        assert tree.scanned - before < len(rows) / 4


def test_byte_table_matches_the_pattern():
    for code in [*range(1, 0x250), 0x3000, 0x212A, 0x1F600]:
        text = f"a{chr(code)}B"
        assert [t.decode() for t in lexical.terms_of(text.encode())] == _terms(text)


def test_no_python_in_the_first_scan_of_facts(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    plan = warc.written_records(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
