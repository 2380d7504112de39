"""Sharding, near-dedup, chat, top-k, line dedup, BPE and decontamination by brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from assayer.llm import bpe, chat, decontaminate, linededup, sharding, simhash, topk
from assayer.llm.catalog import tokenizer_path
from assayer.llm.components import connected_components


def groups_of(edges, nodes=()):
    parent = {n: n for n in nodes}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in list(parent)}


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(50)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)] + [(7, 7), (1, 0), (1, 0)]
    got = connected_components(spark.createDataFrame(edges + [(None, 3)], "a long, b long"), "a", "b").collect()
    alone = {n for n, r in groups_of(edges).items() if n == r and list(groups_of(edges).values()).count(r) == 1}
    assert {r.node: r.root for r in got} == {n: r for n, r in groups_of(edges).items() if n not in alone}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# --- sharding ---------------------------------------------------------------------------


@pytest.mark.parametrize("total", [1, 2, 5, 64, 1000, 4097])
def test_permutation(total):
    rows = np.arange(total)
    places = sharding.permute(rows, total, 9)
    assert sorted(places.tolist()) == rows.tolist()
    assert (sharding.permute(places, total, 9, inverse=True) == rows).all()
    if total > 100:
        assert (places != sharding.permute(rows, total, 10)).mean() > 0.9


def test_shards(spark):
    rows = [(i, f"text {i}") for i in range(50)] + [(7, "text 7"), (None, None), (90, ""), (91, "é" * 40_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int")
    out = sharding.assign_shards(docs, 8, seed=3).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, ())) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.assign_shards(docs.repartition(5), 8, seed=3).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert sharding.assign_shards(docs.limit(0), 8).count() == 0
    ordered = sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert sharding.row_at(ordered[0].shard, ordered[0].slot, len(rows), 8, 3) == 0


# --- SimHash ----------------------------------------------------------------------------


def slow_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for text in (None, "", " \t\n", "One", "a b", "A b C", "x é ü z\x0bq", "w " * 30_000, "ÀB ÀB ÀB ÀB"):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_ball_links_find_every_pair(spark, distance):
    rng = random.Random(distance)
    prints = [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    for p in list(prints):
        for k in range(1, 6):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(64), k)))
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.ball_links(spark.createDataFrame([(p,) for p in signed], "p long"), "p", distance).collect()
    mask = (1 << 64) - 1
    assert all(0 < ((a & mask) ^ (b & mask)).bit_count() <= distance for a, b in links)
    want = groups_of(
        [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= distance], prints
    )
    got = groups_of([(a & mask, b & mask) for a, b in links], prints)
    by = lambda g: sorted(sorted(n for n in g if g[n] == r) for r in set(g.values()))
    assert by(got) == by(want)


def test_near_duplicates(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base + " x"), (8, base), (8, base), (None, base), (9, None), (10, ""), (11, "other words here"), (4, "\t")]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component_id string")
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: r.component_id for r in out} == {5: 3, 3: 3, 8: 3, None: 3, 9: 4, 10: 4, 4: 4, 11: 11}
    assert all(r.fingerprint == f"{slow_fingerprint(t):016x}" for r, t in zip(
        sorted(out, key=lambda r: (r.doc_id or -1, r.fingerprint)),
        [t for _, t in sorted(rows, key=lambda x: (x[0] or -1, f"{slow_fingerprint(x[1]):016x}"))]))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# --- chat -------------------------------------------------------------------------------


def test_escape_round_trip():
    template = chat.ChatTemplate()
    text_of, role_of = template.escaper()
    back = template.unescaper()
    rng = random.Random(6)
    parts = [*template.control, "\\", "\n", "0", "A", "<", "|im_", "end|>", "</", "s>", "é", "[", "INST]"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        escaped = text_of(text)
        assert back(escaped) == text and not any(c in escaped for c in template.control)
        assert back(role_of(text)) == text and "\n" not in role_of(text)


def test_template_is_checked():
    with pytest.raises(ValueError):
        chat.ChatTemplate(control=("<|im_start|>", "<|im_end|>", "0x"))
    with pytest.raises(ValueError):
        chat.ChatTemplate(control=("</s>",))


def test_chat(spark):
    rows = [
        (1, 0, "system", "be"), (1, 2, "assistant", "<|im_end|>\nhi \\ </s>"), (1, 1, "user", None),
        (2, 0, "assistant", "first"), (2, 1, "assistant", ""), (3, 0, "user", "only"),
        (None, 0, "user", "x" * 200_000), (None, None, None, "nobody"), (4, 0, "user", "same"), (4, 0, "user", "same"),
        (5, 0, "<|im_start|>\n", "odd role"),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    segments = chat.format_chats(df)
    out = {r.conv_id: r for r in chat.read_back(segments).collect()}
    whole = {}
    for s in sorted(segments.collect(), key=lambda s: (str(s.conv_id), s.position, s.part)):
        whole[s.conv_id] = whole.get(s.conv_id, "") + s.segment
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        got = out[conv]
        assert got.n_turns == len(turns)
        assert got.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (got.loss_chars, got.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got.formatted_chars == len(whole[conv])
    assert {c: r.in_order for c, r in out.items()} == {1: True, 2: False, 3: True, None: False, 4: False, 5: False}
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0


# --- top-k ------------------------------------------------------------------------------


def slow_top(vectors, queries, k):
    out = []
    for own, q in queries.items():
        scored = sorted((-int(np.dot(q, v)), i) for i, v in vectors.items() if i != own)[:k]
        out += [(own, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_top_k(spark, block_rows):
    rng = np.random.default_rng(block_rows)
    values = {i: rng.normal(size=6).round(1) for i in range(0, 120, 2)}
    values.update({1: values[4], 3: values[4], 5: np.zeros(6), 7: -values[4]})
    ints = {i: np.floor(256 * v).astype(np.int64) for i, v in values.items()}
    rows = [(int(i), [float(x) for x in v]) for i, v in values.items()]
    bad = [(301, None), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows + bad + rows[:3]], "vec_id long, embedding array<double>, id string")
    asked = df.filter("vec_id % 5 = 0 or vec_id is null or vec_id > 300")
    got = topk.exact_top_k(df, asked, 5, block_rows=block_rows, pack_rows=4).collect()
    assert sorted(map(tuple, got)) == slow_top(ints, {i: v for i, v in ints.items() if i % 5 == 0}, 5)
    assert topk.exact_top_k(df, asked.limit(0), 5).count() == 0
    assert topk.exact_top_k(df.limit(0), asked, 5).count() == 0
    few = df.filter("vec_id in (1, 3)")
    assert sorted(map(tuple, topk.exact_top_k(few, few, 5).select("query_id", "rank", "vec_id").collect())) == [(1, 1, 3), (3, 1, 1)]


# --- line dedup -------------------------------------------------------------------------


def line_norm(line):
    return " ".join(w for w in line.strip(" \t\r").lower().split(" ") if w)


def slow_simhash(norm, spark_hash):
    words = set(norm.split())
    return sum(1 << b for b in range(64) if 2 * sum(spark_hash(w) >> b & 1 for w in words) > len(words))


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def xx(word):
    return xxhash.xxh64_intdigest(word.encode(), 42)


def test_native_simhash(spark, monkeypatch):
    rng = random.Random(7)
    lines = [" ".join(f"w{rng.randrange(900)}" for _ in range(n)) for n in (1, 2, 5, 62, 63, 64, 126, 300, 5000)]
    df = spark.createDataFrame([(x,) for x in lines], "x string").withColumn("words", F.split("x", " "))
    for run in (linededup.RUN, 60):  # with the short run, long lines are counted in parts
        monkeypatch.setattr(linededup, "RUN", run)
        got = linededup.line_simhashes(df, ["x"]).collect()
        assert {r.x: r.simhash & ((1 << 64) - 1) for r in got} == {x: slow_simhash(x, xx) for x in lines}


def slow_dedup(rows, config=linededup.LineDedupConfig()):
    first, prints = {}, {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    for k in order:
        for n, line in enumerate((rows[k][1] or "").split("\n")):
            norm = line_norm(line)
            if norm and norm not in first:
                first[norm] = (order.index(k), n)
                if len(norm.split()) >= config.min_words:
                    prints[norm] = slow_simhash(norm, xx)
    names = sorted(prints)
    links = [
        (a, b) for i, a in enumerate(names) for b in names[i + 1 :]
        if (prints[a] ^ prints[b]).bit_count() <= config.distance
        and edit(a, b) <= int(max(len(a), len(b)) * (1 - config.similarity) + 1e-9)
    ]
    root = groups_of(links, first)
    kept = {}
    for norm, at in first.items():
        kept[root[norm]] = min(kept.get(root[norm], at), at)
    out = []
    for k, (i, text) in enumerate(rows):
        lines = None if text is None else [
            line for n, line in enumerate(text.split("\n"))
            if not line_norm(line) or kept[root[line_norm(line)]] == (order.index(k), n)
        ]
        out.append((i, None if lines is None else "\n".join(lines)))
    return out


def test_line_dedup(spark):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "su", "te") for b in ("n", "ra", "vex", "dor", "qui")]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 60))) for _ in range(40)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(base)
            kind = rng.random()
            if kind < 0.3 and len(line.split()) > 30:
                parts = line.split()
                parts[rng.randrange(len(parts))] += "s"
                line = " ".join(parts)
            elif kind < 0.5:
                line = line.title() + "!"
            lines.append(rng.choice(["", " "]) if kind > 0.95 else line)
        rows.append((i * 3, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, " \t"), (None, base[0] + "\nof its own"), (503, "x y " * 3000)]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, line string, _row int")
    out = linededup.dedup_lines(docs, removed_col="gone")
    assert out.columns == [*docs.columns, "gone"]
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert got == set(slow_dedup(rows))
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "one line\n\ntwo lines"), (1, "one line\n\ntwo lines"), (2, "two lines")], "doc_id long, text string")
    out = sorted(r.text for r in linededup.dedup_lines(docs).collect())
    assert out == ["", "", "one line\n\ntwo lines"]


# --- BPE --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    with open(tokenizer_path(), encoding="utf-8") as file:
        return bpe.Tokenizer(file.read())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def odd_texts():
    rng = random.Random(9)
    alphabet = list("abcdeiou  \n\t'stredm.,!?0123ÀÉéßσΣςİıﬁ½²ªº٣अ中文😀́  ​\x1c\x85") + [
        "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "the", " and", "</w>"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(800)]


def test_merge_equals_the_library(tokenizer, library):
    for text in [*odd_texts(), "a" * 3000, "ab" * 2000 + "!" * 500, ""]:
        ids = []
        for part in tokenizer.parts(text):
            ids += [part] if isinstance(part, int) else [i for w in part for i in tokenizer.merge(w)]
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_automaton(tmp_path, tokenizer):
    rng = random.Random(10)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))) for _ in range(2000)})
    data = bpe.compile_automaton([(w, tokenizer.merge(w)) for w in words])
    path = tmp_path / "lexicon.bin"
    path.write_bytes(data)
    lexicon = bpe.Automaton(str(path))
    assert all(lexicon.get(w) == tokenizer.merge(w) for w in words)
    assert all(lexicon.get(w) is None for w in ("", "d", "abcd", "aaaaaaaaa", "zé") if w not in words)
    # Minimal: no more states than a brute-force count of different right languages.
    prefixes = {w[:k] for w in (x.encode() for x in words) for k in range(len(w) + 1)}
    own = {w.encode() for w in words}
    tails = {}
    for w in own:
        for k in range(len(w) + 1):
            tails.setdefault(w[:k], set()).add(w[k:])
    assert len(lexicon.first) - 1 == len({frozenset(tails[p]) for p in prefixes})
    (tmp_path / "none.bin").write_bytes(bpe.compile_automaton([]))
    assert bpe.Automaton(str(tmp_path / "none.bin")).get("a") is None


@pytest.mark.parametrize("size", [0, 50, 100_000])
def test_codec(spark, library, size):
    texts = [*odd_texts()[:200], None, "", "long " * 300_000, "the the the"]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, ids string")
    codec = bpe.BpeCodec.build(df, "text", tokenizer_path(), size)
    out = df.select("doc_id", codec.encode(F.col("text")).alias("i")).withColumn("d", codec.decode(F.col("i")))
    both = df.select("doc_id", codec.round_trip(F.col("text")).alias("b")).select("doc_id", "b.*")
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, out.collect()))
    for r in out.collect():
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.i == want and r.d == library.decode(want, skip_special_tokens=False)
    assert df.limit(0).select(codec.encode(F.col("text"))).count() == 0


def test_other_tokenizers_are_refused():
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as file, pytest.raises(Exception):
        bpe.Tokenizer(file.read())


# --- decontamination --------------------------------------------------------------------


def slow_tiles(a, b, least):
    """Greedy string tiling by looking at every pair of positions."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), 0
    while True:
        best = 0
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best:
                    best, at = n, []
                if n == best and n:
                    at.append((i, j))
        if best < least:
            return out
        for i, j in at:
            if all(free_a[i : i + best]) and all(free_b[j : j + best]):
                free_a[i : i + best] = free_b[j : j + best] = [False] * best
                out += best


def test_tiles_by_brute_force():
    rng = random.Random(11)
    for _ in range(60):
        a = [rng.randrange(4) for _ in range(rng.randint(1, 25))]
        b = [rng.randrange(-1, 4) for _ in range(rng.randint(1, 40))]
        got = decontaminate.tile(np.array(a), np.array(b), 3)
        assert sum(n for _, _, n in got) == slow_tiles(a, [x if x >= 0 else None for x in b], 3)
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in got)


def test_contaminations(spark):
    rng = random.Random(12)
    words = [f"v{k}" for k in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, text(rng.randint(20, 50))) for k in range(12)] + [(50, "tiny item"), (51, None), (52, "...")]
    halves = items[3][1].split()
    docs = [
        (1, text(80) + " " + items[0][1].upper() + ", " + text(30)),
        (2, " ".join(halves[len(halves) // 2 :]) + " " + text(9) + " " + " ".join(halves[: len(halves) // 2])),
        (3, text(200)), (4, None), (5, ""), (6, " ".join(items[1][1].split()[:6]) + " " + text(50)),
        (7, "a Tiny, item!"), (8, text(30_000) + " " + items[5][1]), (1, items[0][1]), (None, items[2][1]),
    ]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, item_id string, coverage int")
    bench = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, doc_id string")
    for chars in (200, 16_000_000):  # many blocks, one block
        config = decontaminate.TilingConfig(block_chars=chars)
        got = decontaminate.contaminations(df, bench, config=config).collect()
        assert {(r.doc_id, r.item_id) for r in got} == {(1, 0), (2, 3), (7, 50), (8, 5), (None, 2)}
        assert len(got) == 6 and all(r.coverage >= 0.5 for r in got)
        clean = decontaminate.clean_documents(df, bench, config=config)
        assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {3, 4, 5, 6}
    assert decontaminate.contaminations(df, bench.limit(0)).count() == 0
    assert decontaminate.contaminations(df.limit(0), bench).count() == 0
    assert decontaminate.clean_documents(df, bench.limit(0)).count() == len(docs)
