import hashlib
import random
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from assayer.functions import numeric as N
from assayer.functions import terms as TM
from assayer.functions import text as X

SPACES = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]


def one(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("c")).alias("o")).collect()]


def test_every_whitespace_character(spark):
    assert len(SPACES) == 29
    assert one(spark, SPACES, X.is_blank) == [True] * 29
    assert one(spark, [f"a{s}b" for s in SPACES], X.collapse_ws) == ["a b"] * 29
    assert one(spark, [f"{s}{s}a{s} b{s}" for s in SPACES], X.collapse_ws) == ["a b"] * 29
    assert one(spark, [f"{s}a b{s}" for s in SPACES], X.strip) == ["a b"] * 29
    # Zero-width space and letters next to the tested ranges are not whitespace.
    for c in ("​", "é", "ᚁ", "、", "\x7f", "﻿"):
        assert one(spark, [c, f"a{c}b"], X.is_blank) == [False, False]
        assert one(spark, [f"a{c}b"], X.collapse_ws) == [f"a{c}b"]


def test_blank_and_null(spark):
    assert one(spark, [None, "", " \t\n", " ", "x"], X.is_blank) == [True] * 4 + [False]
    assert one(spark, [None, "  A\tB  "], X.norm_text) == ["", "a b"]


def test_content_hash(spark):
    df = spark.createDataFrame([("My  Tool", None)], "n string, d string")
    got = df.select(X.content_hash(F.col("n"), F.col("d"))).first()[0]
    assert got == hashlib.sha1(b"my tool||").hexdigest()


def test_truncation_counts_code_points(spark):
    texts = ["a" * 899, "a" * 900, "a" * 901, "a" * 899 + "\U0001f600b"]
    got = one(spark, texts, X.description_or_default)
    assert got == [t[:900] for t in texts]
    assert got[3].endswith("\U0001f600")


def test_defaults(spark):
    assert one(spark, ["  ", " x  y "], X.name_or_default) == ["unknown_tool", "x  y"]
    assert one(spark, ["\n", " x  y "], X.description_or_default) == ["(no description provided)", "x y"]


def test_label_words_are_substrings_in_label_order(spark):
    got = one(spark, ["ai-readme", "Other EXECUTE write", "none"], lambda c: X.label_words_in(c))
    assert got == [["read"], ["write", "execute", "other"], []]


@pytest.mark.parametrize("value", [0.25, 0.35, 0.75, 0.15, 1.05, 2.5, 1234.65, 0.05, 99.95, 0.0, 7.0, 1e6 + 0.25])
def test_rounding_matches_exact_half_even(spark, value):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(N.round_half_even_1dp(F.col("x"))).first()[0] == round(value, 1)


def test_rounding_property(spark):
    df = spark.range(20000).select((F.col("id") / 7.0 + F.col("id") * 0.05).alias("x"))
    rows = df.select("x", N.round_half_even_1dp(F.col("x")).alias("y")).collect()
    assert all(r.y == round(r.x, 1) for r in rows)


def expected_tokens(text):
    lowered = "".join(
        c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c)
    )
    word, out = "", []
    for c in lowered + " ":
        if c.isalnum() or c == "_":
            word += c
        else:
            if len(word) > 1:
                out.append(word)
            word = ""
    return out


def test_tokens(spark):
    texts = [
        "Café au lait", "straße STRASSE ß", "a b c", "snake_case x1 _ __", "1 22 333", "",
        "ﬁne ½ x² Å naïve", "Ελληνικά ΣΑΣ", "日本語 テスト", "éä", "İstanbul ı", "don't stop-me",
        "한국어 말", "ก็ดี เป็น", "١٢٣ ​zero",
    ]
    assert one(spark, texts, TM.tokens) == [expected_tokens(t) for t in texts]


def test_tokens_of_every_letter_block(spark):
    texts = [
        "".join(chr(c) for c in range(start, start + 64)) for start in range(0xA0, 0x3000, 64)
    ]
    # Characters that every Unicode version in use knows: a JVM may be older than Python here.
    known = unicodedata.ucd_3_2_0.category
    assigned = ["".join(c for c in t if known(c) not in ("Cn", "Cs", "Co")) for t in texts]
    assert one(spark, assigned, TM.tokens) == [expected_tokens(t) for t in assigned]


def test_bigrams(spark):
    make = lambda c: TM.unigrams_and_bigrams(TM.tokens(c))
    got = one(spark, ["aa bb cc", "aa", "", "aa aa aa"], make)
    assert got == [
        ["aa", "bb", "cc", "aa bb", "bb cc"], ["aa"], [], ["aa", "aa", "aa", "aa aa", "aa aa"],
    ]


def test_random_texts(spark):
    pool = SPACES + list("abcXYZ019_-.,;'\"") + list("éÅßñœÆŒĳﬁ½²ΣςИйあア漢한") + [
        "́", "̧", "​", "\U0001f600", "​", "\x00", "\x7f", "\\", "$1",
    ]
    rng = random.Random(7)
    texts = ["".join(rng.choices(pool, k=rng.randrange(0, 60))) for _ in range(1500)]
    collapsed = [" ".join(t.split()) for t in texts]
    assert one(spark, texts, X.collapse_ws) == collapsed
    assert one(spark, texts, X.norm_text) == [t.lower() for t in collapsed]
    assert one(spark, texts, X.strip) == [t.strip() for t in texts]
    assert one(spark, texts, X.is_blank) == [not t.strip() for t in texts]
    assert one(spark, texts, X.char_length) == [len(t) for t in texts]
    assert one(spark, texts, TM.tokens) == [expected_tokens(t) for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    hashes = df.orderBy("i").select(X.content_hash(F.col("c"), F.col("c")).alias("h")).collect()
    want = [hashlib.sha1(f"{t.lower()}||{t.lower()}".encode()).hexdigest() for t in collapsed]
    assert [r.h for r in hashes] == want


def test_accents_fold_as_unicode_says_for_every_character(spark):
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    rows = ["x".join(chars[i : i + 150]) for i in range(0, len(chars), 150)]
    rows += ["".join(chars[i : i + 41]) for i in range(0x80, 0x4000, 41)]  # neighbours touch, marks among them
    rows += ["한국어 각각 ﬃ½ ﬁﬁ", "ệ ệ ệ", "", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    out = df.select("t", TM.fold_accents(F.col("t")).alias("f"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString().split("Scan")[0]
    for r in out.collect():
        want = r["t"] and "".join(c for c in unicodedata.normalize("NFKD", r["t"]) if not unicodedata.combining(c))
        assert r["f"] == want
