"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The corpus' most frequent words are merged once and compiled into an acyclic automaton that
shares prefixes and suffixes. Every arc carries a number; the numbers along a word's path add up
to the word's place, and the place gives its ids. The automaton is one file that every Python
worker maps into memory. A word that it lacks is merged exactly, so the lexicon decides only how
fast ids come, never which.

The tokenizer file holds a word-end BPE over the byte alphabet: NFC, white space, lower case,
then a pattern for words. Any other pipeline in the file is refused. Strings of its added tokens
are found in the raw text first, as the tokenizer's library does.

Null and empty texts, and texts of white space, give no ids; no ids decode to an empty text. A
null id list decodes to null. Rows are independent, so repeated rows and extra columns do not
matter, and an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast, SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm.subwords import PIECE_CHARS, live, pieces
from assayer.session import ensure_checkpoint_dir, materialize

LEXICON_WORDS = 100_000
SHORT_WORD = 64  # symbols up to which a word is merged by scans, without a queue
_SPACE = regex.compile(r"\s+")
# Texts are cut for counting and encoding where white space follows other text: no word crosses it.
_BREAK = re.compile(r"(?<=\S) ")


def _byte_alphabet() -> list[str]:
    """The character for each byte: itself if printable in Latin-1, else the next one from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_SPACES = "".join(chr(c) for c in range(0x3001) if regex.match(r"\s", chr(c)))


def _latin_pattern(pattern: str) -> str:
    """The pattern for texts of characters below U+0100, whose classes are spelt out."""
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        members = "".join(f"\\x{c:02x}" for c in range(256) if regex.match(name, chr(c)))
        pattern = pattern.replace(name, members)
    return pattern


class Tokenizer:
    """The merge table and text rules of one tokenizer file."""

    def __init__(self, text: str):
        """``text`` is the content of the file."""
        spec = json.loads(text)
        model, steps = spec["model"], spec["normalizer"]["normalizers"]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        known = (
            model["type"] == "BPE" and not model["dropout"] and not model["byte_fallback"]
            and not model["continuing_subword_prefix"] and not model["ignore_merges"]
            and model["unk_token"] is None and spec.get("decoder") is None
            and [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
            and split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"]
            and level["type"] == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"]
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        )
        if not known:
            raise ValueError("the tokenizer file asks for steps that are not built")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.words = regex.compile(split["pattern"]["Regex"])
        self.latin_words = re.compile(_latin_pattern(split["pattern"]["Regex"]))
        # The step that makes one space of white space changes no word, since no word has any.
        self.spaceless = not any(self.words.findall(c) for c in _SPACES)
        self.alphabet = _byte_alphabet()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_at = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.ranks = {pair: rank for pair, (rank, _) in self.merges.items()}
        self.made = {rank: new for rank, new in self.merges.values()}
        self.no_rank = len(model["merges"])
        self.inner = [self.vocab.get(c) for c in self.alphabet]
        self.last = [self.vocab.get(c + self.suffix) for c in self.alphabet]
        size = 1 + max([*self.vocab.values(), *self.added.values(), -1])
        self.strings = np.full(size, "", object)
        for token, i in chain(self.vocab.items(), self.added.items()):
            self.strings[i] = token


    def split(self, text: str) -> list[str]:
        """The normalised words of a text without added tokens."""
        try:
            text.encode("latin-1")  # such a text is in NFC
        except UnicodeEncodeError:
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            if not self.spaceless:
                text = _SPACE.sub(" ", text)
            # Lower case letter by letter: a final sigma has no form of its own here.
            return self.words.findall(text.replace("Σ", "σ").lower())
        return self.latin_words.findall((text if self.spaceless else _SPACE.sub(" ", text)).lower())

    def parts(self, text: str | None) -> Iterator[list[str] | int]:
        """Lists of words, and ids of added tokens between them, over the whole text."""
        at = 0
        text = text or ""
        for found in self.added_at.finditer(text) if any(a in text for a in self.added) else ():
            yield from map(self.split, pieces(text[at : found.start()], _BREAK))
            yield self.added[found.group()]
            at = found.end()
        yield from map(self.split, pieces(text[at:] if at else text, _BREAK))

    def merge(self, word: str) -> list[int]:
        """Exact ids: the pair of least rank first, the leftmost among equals, until none is left."""
        data = word.encode("utf-8", "surrogatepass")
        ids = [self.inner[b] for b in data[:-1]] + [self.last[b] for b in data[-1:]]
        if None in ids:
            ids = [i for i in ids if i is not None]
        if len(ids) <= SHORT_WORD:
            # Few pairs: their least rank is found by a scan, and a merge changes two of them.
            rank_of, none = self.ranks.get, self.no_rank
            ranks = [rank_of(pair, none) for pair in zip(ids, ids[1:])]
            while ranks and (least := min(ranks)) != none:
                at = ranks.index(least)
                new = self.made[least]
                ids[at : at + 2] = [new]
                del ranks[at]
                if at:
                    ranks[at - 1] = rank_of((ids[at - 1], new), none)
                if at < len(ranks):
                    ranks[at] = rank_of((new, ids[at + 1]), none)
            return ids
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        queue = [
            (*self.merges[pair], i) for i, pair in enumerate(zip(ids, ids[1:])) if pair in self.merges
        ]
        queue = [(rank, i, new) for rank, new, i in queue]
        heapq.heapify(queue)
        while queue:
            _, i, new = heapq.heappop(queue)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or self.merges.get((ids[i], ids[j]), (0, -1))[1] != new:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (ids[a], ids[b]) in self.merges:
                    rank, made = self.merges[ids[a], ids[b]]
                    heapq.heappush(queue, (rank, a, made))
        return [i for i in ids if i >= 0]


# --- the automaton ---------------------------------------------------------------------------

_HEAD = np.dtype([("states", "<i8"), ("arcs", "<i8"), ("words", "<i8"), ("ids", "<i8")])


def compile_automaton(entries: Sequence[tuple[str, Sequence[int]]]) -> bytes:
    """The file of the minimal automaton of ``(word, ids)``; words differ from each other."""
    words = sorted((word.encode("utf-8", "surrogatepass"), tuple(ids)) for word, ids in entries)
    # Equal states (same end mark, same arcs) get one number; children are numbered before parents.
    register: dict[tuple, int] = {}
    below: list[int] = []  # words that end in a state or behind it

    def close(state: list) -> int:
        final, arcs = state
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(below)
            below.append(int(final) + sum(below[target] for _, target in arcs))
        return register[key]

    path = [[False, []]]
    last = b""
    for word, _ in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        while len(path) - 1 > common:
            done = path.pop()
            path[-1][1].append((last[len(path) - 1], close(done)))
        path += [[False, []] for _ in word[common:]]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        done = path.pop()
        path[-1][1].append((last[len(path) - 1], close(done)))
    root = close(path[0])
    states = sorted(register.items(), key=lambda x: x[1])
    first = np.zeros(len(states) + 1, "<i4")
    labels, targets, adds = bytearray(), [], []
    final = np.zeros(len(states), "u1")
    for (ends, arcs), number in states:
        passed = int(ends)
        final[number] = ends
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            adds.append(passed)
            passed += below[target]
        first[number + 1] = len(labels)
    starts = np.cumsum([0, *(len(ids) for _, ids in words)]).astype("<i4")
    flat = np.fromiter(chain.from_iterable(ids for _, ids in words), "<i4", int(starts[-1]))
    assert root == len(states) - 1
    head = np.array([(len(states), len(labels), len(words), len(flat))], _HEAD)
    return b"".join(
        x.tobytes() if isinstance(x, np.ndarray) else bytes(x)
        for x in (head, first, np.array(targets, "<i4"), np.array(adds, "<i4"), starts, flat, final, labels)
    )


class Automaton:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        states, arcs, words, ids = (int(x) for x in np.frombuffer(self.map, _HEAD, 1)[0])
        at = _HEAD.itemsize
        views = []
        for size in (states + 1, arcs, arcs, words + 1, ids):
            views.append(memoryview(self.map)[at : at + 4 * size].cast("i"))
            at += 4 * size
        self.first, self.target, self.add, self.start, self.ids = views
        self.final = memoryview(self.map)[at : at + states]
        self.labels = at + states
        self.root = states - 1

    def get(self, word: str) -> list[int] | None:
        """The ids of a word, or None if the lexicon lacks it."""
        state, place = self.root, 0
        first, labels, find = self.first, self.labels, self.map.find
        for byte in word.encode("utf-8", "surrogatepass"):
            arc = find(_BYTES[byte], labels + first[state], labels + first[state + 1]) - labels
            if arc < 0:
                return None
            place += self.add[arc]
            state = self.target[arc]
        return list(self.ids[self.start[place] : self.start[place + 1]]) if self.final[state] else None


_BYTES = [bytes([b]) for b in range(256)]


# --- on tables -------------------------------------------------------------------------------


def word_counts(docs: DataFrame, text_col: str, spec: Broadcast) -> DataFrame:
    """``word, n`` over all texts; counted per task first, in a table of bounded size."""
    key = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = live(key, lambda: Tokenizer(spec.value)), Counter()

        def flush() -> pa.RecordBatch:
            words = [w.encode("utf-8", "replace").decode() for w in counts]
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
            )
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for part in tokens.parts(text):
                    if not isinstance(part, int):
                        counts.update(part)
                if len(counts) > 200_000:
                    yield flush()
        yield flush()

    partial = docs.select(text_col).mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def ship_lexicon(spark: SparkSession, tokenizer: Tokenizer, words: Sequence[str]) -> str:
    """Compile ``words`` and hand the file to all executors; returns its name there.

    The file is written to the shared checkpoint folder, from where executors fetch it, also
    those that join later.
    """
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    data = compile_automaton([(word, tokenizer.merge(word)) for word in words])
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark), name)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    try:
        stream.write(data)
    finally:
        stream.close()
    spark.sparkContext.addFile(path.toString())
    return name


def frequent_words(docs: DataFrame, text_col: str, spec: Broadcast, size: int = LEXICON_WORDS) -> list[str]:
    """The ``size`` most frequent words of all texts; of words as frequent as the next one, none.

    The driver gets a table of how many words have each count, added up to powers of two over
    4,096, and then the words chosen.
    """
    counts = materialize(word_counts(docs, text_col, spec))
    # Counts that share their first 12 binary digits are told apart by nothing: one step of the table.
    step = F.expr("n - n % shiftleft(1L, cast(greatest(0, floor(log2(n)) - 11) as int))")
    seen, least = 0, None
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        if seen + row["count"] > size:
            break
        seen, least = seen + row["count"], row["step"]
    if least is None:
        return []
    return [r["word"] for r in counts.filter(F.col("n") >= least).select("word").collect()]


class _Encoder:
    """Ids of whole texts; a bounded table in front keeps the ids of words met before."""

    def __init__(self, tokenizer: Tokenizer, lexicon: Automaton, max_words: int = 200_000):
        self.tokenizer, self.lexicon, self.max_words = tokenizer, lexicon, max_words
        self.places: dict[str | int, int] = {}
        self.common: list[str] = []  # the words in the table that the lexicon has
        self.sizes = np.zeros(1024, np.int64)
        self.starts = np.zeros(1024, np.int64)
        self.flat = np.zeros(4096, np.int32)
        self.used = 0

    def _forget(self) -> None:
        """Drop the words that the lexicon lacks; all words, if its words alone fill half the table."""
        kept = self.common if len(self.common) <= self.max_words // 2 else []
        ids, sizes = self._gather(np.fromiter(map(self.places.__getitem__, kept), np.int64, len(kept)))
        self.common = list(kept)
        self.places = {word: place for place, word in enumerate(kept)}
        self.used = 0
        self._append(sizes, ids)

    def _append(self, sizes: Sequence[int], ids: Sequence[int]) -> None:
        """The ids of the words placed last; ``places`` counts these words already."""
        total, end = len(self.places), self.used + len(ids)
        first = total - len(sizes)
        if total > len(self.sizes):
            self.sizes = np.resize(self.sizes, 2 * total)
            self.starts = np.resize(self.starts, 2 * total)
        if end > len(self.flat):
            self.flat = np.resize(self.flat, 2 * end)
        self.sizes[first:total] = sizes
        ends = self.used + np.cumsum(self.sizes[first:total])
        self.starts[first:total] = ends - self.sizes[first:total]
        self.flat[self.used : end] = ids
        self.used = end

    def _gather(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at some places, and how many each word has."""
        sizes = self.sizes[place]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[place] - (ends - sizes), sizes) + np.arange(total)], sizes

    def _learn(self, words: set) -> None:
        new = words - self.places.keys()
        if len(self.places) + len(new) > self.max_words and self.places:
            self._forget()
            new = words - self.places.keys()
        sizes, flat = [], []
        for word in new:
            if isinstance(word, int):
                ids = [word]
            elif (ids := self.lexicon.get(word)) is None:
                ids = self.tokenizer.merge(word)
            else:
                self.common.append(word)
            self.places[word] = len(self.places)
            sizes.append(len(ids))
            flat += ids
        self._append(sizes, flat)

    def _ids(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words, and how many each word has."""
        self._learn(set(words))
        return self._gather(np.fromiter(map(self.places.__getitem__, words), np.int64, len(words)))

    def encode(self, texts: Sequence[str | None]) -> pa.ListArray:
        arrays, counts = [], []
        # Words of several short texts go through numpy together; a long text goes in parts.
        group: list = []
        ends: list[int] = []

        def flush() -> None:
            if ends:
                words = np.array([0, *ends])
                ids, sizes = self._ids(group)
                counts.extend(np.diff(np.concatenate([[0], np.cumsum(sizes)])[words]).tolist())
                arrays.append(ids)
                group.clear()
                ends.clear()

        for text in texts:
            if text is not None and len(text) > PIECE_CHARS:
                flush()
                whole = [self._ids([p] if isinstance(p, int) else p)[0] for p in self.tokenizer.parts(text)]
                arrays += whole
                counts.append(sum(map(len, whole)))
                continue
            for part in self.tokenizer.parts(text):
                if isinstance(part, int):
                    group.append(part)
                else:
                    group += part
            ends.append(len(group))
            if len(group) > 100_000:
                flush()
        flush()
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        flat = np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def _slices(batches: Iterator[pa.Array], rows: int = 256) -> Iterator[pa.Array]:
    """Few rows at a time, so that ids and strings of a whole batch never exist together."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _decoded(ids: pa.ListArray, strings: np.ndarray) -> pa.Array:
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.array(ids.value_lengths().fill_null(0))).tolist()
    texts, at = [], 0
    for end, ok in zip(ends, ids.is_valid().to_pylist()):
        texts.append(" ".join(strings[flat[at:end]].tolist()) if ok else None)
        at = end
    return pa.array(texts, pa.string())


@dataclass(frozen=True)
class BpeCodec:
    """Column functions of a tokenizer and a shipped lexicon."""

    spec: Broadcast  # the tokenizer file's content, a fixed size
    lexicon: str

    @classmethod
    def build(cls, docs: DataFrame, text_col: str, path: str, lexicon_words: int = LEXICON_WORDS) -> BpeCodec:
        """Count the words of all texts, compile the lexicon, ship it."""
        spark = docs.sparkSession
        with open(path, encoding="utf-8") as file:
            spec = spark.sparkContext.broadcast(file.read())
        words = frequent_words(docs, text_col, spec, lexicon_words)
        return cls(spec, ship_lexicon(spark, Tokenizer(spec.value), words))

    def encode(self, text: Column) -> Column:
        """The ids of every whole text."""
        spec, name = self.spec, self.lexicon

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = live(name, lambda: _Encoder(Tokenizer(spec.value), Automaton(SparkFiles.get(name))))
            for part in _slices(batches):
                yield encoder.encode(part.to_pylist())

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, T.ArrayType(T.IntegerType()))(text)

    def decode(self, ids: Column) -> Column:
        """The tokens of the ids, joined by spaces, special tokens included."""
        spec, name = self.spec, f"strings of {self.lexicon}"

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            strings = live(name, lambda: Tokenizer(spec.value)).strings
            for part in _slices(batches):
                yield _decoded(part, strings)

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, T.StringType())(ids)

    def round_trip(self, text: Column) -> Column:
        """``struct(ids, decoded)``: :meth:`encode`, then :meth:`decode` of its ids, in one worker."""
        spec, name = self.spec, self.lexicon
        kind = T.StructType().add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = live(name, lambda: _Encoder(Tokenizer(spec.value), Automaton(SparkFiles.get(name))))
            for part in _slices(batches):
                ids = encoder.encode(part.to_pylist())
                yield pa.StructArray.from_arrays(
                    [ids, _decoded(ids, encoder.tokenizer.strings)], names=["ids", "decoded"]
                )

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, kind)(text)
