"""WARC archives: written with revisit records and segments, read back by segment reassembly.

**Writing.** Rows with equal payloads make one ``response`` (the largest id, then the largest url) and
``revisit`` records that name it. A response's payload travels in chunked transfer framing below its
HTTP head; a block longer than ``segment_bytes`` is cut into a first record and ``continuation``
records, which name their origin, count from 2, and close with the total length. Archives are gzip
files in the shared folder; Spark's text writer ends every record by the two line ends WARC asks for.

**Reading.** Spark's text reader streams each gzip file through one task, cut at double line ends; the
pieces are put together again by every record's Content-Length, so a payload may hold anything, also a
whole WARC record. Segments are grouped by origin, ordered by number, checked for gaps and against the
total length; then the chunks are joined and the payload is checked against its SHA-1.

**Odd rows.** A null payload is the empty one, and equals it. Null ids and null urls leave their field
out and come back null; a null id sorts below every other. Control characters of a url come back
percent-encoded, blanks around it don't. Rows
equal in id, url and payload are separate records: one response, all others revisits. Payloads shorter
than ``min_revisit_bytes`` are always responses. Very long payloads become many segments; one record is
held in memory at a time. An empty table gives archives without a record. Other columns are ignored.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import urllib.parse
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.bitmaps import bitmap, flagged
from assayer.llm.linededup import stored
from assayer.operators.skew import hot_keys, salted_join
from assayer.session import ensure_checkpoint_dir

END = b"\r\n\r\n"
BATCH_BYTES = 16 << 20

# The digits of base 32 as `conv` writes them, and as RFC 4648 does.
CONV_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass(frozen=True)
class WarcConfig:
    segment_bytes: int = 65_536
    chunk_bytes: int = 16_384
    min_revisit_bytes: int = 0


class BrokenArchive(ValueError):
    pass


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: four groups of 40 bits, eight digits each."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), CONV_DIGITS, BASE32_DIGITS)


def _record_id(copy: Column) -> Column:
    """A name-based URN of id, url, digest and copy number."""
    name = F.md5(F.to_json(F.struct("id", "url", "digest", copy.alias("copy"))))
    parts = [F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing: every chunk under its length in hexadecimal digits, then one of length 0."""
    out = []
    for at in range(0, len(payload), size):
        chunk = payload[at : at + size]
        out += [b"%x\r\n" % len(chunk), chunk, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailing fields are read over."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";", 1)[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise BrokenArchive("a chunk has no length")
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            raise BrokenArchive("a chunk is cut short")
        out.append(body[at : at + n])
        at += n + 2


def http_payload(block: bytes) -> bytes:
    """The body below an HTTP head, without its transfer framing."""
    head, found, body = block.partition(END)
    if not found:
        raise BrokenArchive("a block has no HTTP head")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head) else body


def records_of(page: dict, config: WarcConfig, date: str) -> Iterator[bytes]:
    """The records of one row, each without its closing line ends."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if page["type"] == "response":
        block += chunked(page["payload"], config.chunk_bytes)
    fields = [("WARC-Type", page["type"]), ("WARC-Record-ID", f"<{page['record']}>"), ("WARC-Date", date)]
    if page["url"] is not None:
        # Only what would end the field is encoded.
        safe = re.sub(r"[\x00-\x1f\x7f]", lambda c: urllib.parse.quote(c[0]), page["url"])
        fields.append(("WARC-Target-URI", safe))
    if page["id"] is not None:
        fields.append(("X-Row-ID", urllib.parse.quote(page["id"])))
    if page["type"] == "revisit":
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{page['refers']}>"),
        ]
    fields += [("WARC-Payload-Digest", f"sha1:{page['digest']}"), ("Content-Type", "application/http; msgtype=response")]
    cuts = range(0, len(block), config.segment_bytes)
    for number, at in enumerate(cuts, 1):
        own = fields
        if number > 1:
            own = [
                ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, page['record'] + str(number))}>"),
                ("WARC-Date", date), ("WARC-Segment-Origin-ID", f"<{page['record']}>"),
            ]
        if len(cuts) > 1:
            own = [*own, ("WARC-Segment-Number", number)]
            if number == len(cuts):
                own.append(("WARC-Segment-Total-Length", len(block)))
        part = block[at : at + config.segment_bytes]
        head = "".join(f"{name}: {value}\r\n" for name, value in [*own, ("Content-Length", len(part))])
        yield b"WARC/1.1\r\n" + head.encode() + b"\r\n" + part


def written_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    config: WarcConfig = WarcConfig(),
) -> DataFrame:
    """``type, record, refers, id, url, digest, payload`` of every record but continuations.

    Which row answers for a payload is settled on rows without it; payloads move only where their
    digest occurs more than once, and then each row of one id, url and payload counts once.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns({"digest": sha1_base32(F.col("payload")), "size": F.octet_length("payload")})
    same = ("id", "url", "digest")
    facts = stored(
        rows.filter(F.col("size") >= config.min_revisit_bytes).groupBy(*same).agg(F.count(F.lit(1)).alias("m"))
    )
    heads = stored(
        facts.groupBy("digest").agg(F.sum("m").alias("n"), F.max(F.struct("id", "url")).alias("head")).filter("n > 1")
    )
    placed = facts.withColumn("name", F.xxhash64(*same))
    decided = stored(
        salted_join(placed, heads, "digest", hot_keys(heads, "digest", "n"), "name")
        .withColumn("is_head", F.struct("id", "url").eqNullSafe(F.col("head"))).drop("name")
    )
    one = F.lit(0).cast("long")
    refers = F.col("head")
    # Copies of one row in blocks of 1,024, which are dealt out before they become rows.
    copies = decided.withColumn("n", F.col("m") - F.col("is_head").cast("long")).filter("n > 0")
    blocks = copies.withColumn("block", F.explode(F.expr("sequence(0L, (n - 1) div 1024)"))).repartition(*same, "block")
    revisits = blocks.withColumn(
        "copy", F.explode(F.expr("sequence(block * 1024L + 1, least(n, (block + 1) * 1024L))"))
    ).withColumn("record", _record_id(F.col("copy")))
    named = revisits.withColumns({"own_id": F.col("id"), "own_url": F.col("url"), "id": refers["id"], "url": refers["url"]})
    revisits = named.withColumn("refers", _record_id(one)).select(
        F.lit("revisit").alias("type"), "record", "refers", F.col("own_id").cast("string").alias("id"),
        F.col("own_url").alias("url"), "digest", F.lit(None).cast("binary").alias("payload"),
    )

    marked = flagged(rows, F.xxhash64("digest"), bitmap(heads.select(F.xxhash64("digest").alias("h")), "h"), "repeats")
    small = F.col("size") < config.min_revisit_bytes
    alone = marked.filter(~F.col("repeats") & ~small).withColumn("record", _record_id(one))
    short = marked.filter(small).withColumn("record", F.concat(F.lit("urn:uuid:"), F.uuid()))
    met = marked.filter(F.col("repeats") & ~small).groupBy(*same).agg(F.first("payload").alias("payload"))
    losers = decided.filter(~F.col("is_head")).select(_record_id(one).alias("record"))
    heads_only = met.withColumn("record", _record_id(one)).join(losers, "record", "left_anti")
    kept = ("record", "id", "url", "digest", "payload")
    responses = alone.select(*kept).unionByName(heads_only.select(*kept))
    if config.min_revisit_bytes > 0:
        responses = responses.unionByName(short.select(*kept))
    return responses.select(
        F.lit("response").alias("type"), "record", F.lit(None).cast("string").alias("refers"),
        F.col("id").cast("string").alias("id"), "url", "digest", "payload",
    ).unionByName(revisits)


def write_archives(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    config: WarcConfig = WarcConfig(), folder: str | None = None,
) -> str:
    """Write every row of ``pages`` into gzip archives under ``folder`` (default: a new shared one); returns it."""
    folder = folder or f"{ensure_checkpoint_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    date = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                for record in records_of(batch.slice(at, 1).to_pylist()[0], config, date):
                    out.append(record)
                    size += len(record)
                if size > BATCH_BYTES:
                    yield pa.record_batch([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
        if out:
            yield pa.record_batch([pa.array(out, pa.binary())], ["value"])

    records = written_records(pages, id_col, url_col, payload_col, config).mapInArrow(frame, "value binary")
    text = records.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", END.decode()).option("compression", "gzip").text(folder)
    return folder


class RecordParser:
    """Records of one archive from its bytes, whatever the pieces they come in."""

    def __init__(self, file: str):
        self.file, self.buffer, self.need = file, bytearray(), 0
        self.fields: dict[str, str] | None = None

    def feed(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.buffer += piece
        while len(self.buffer) >= self.need:
            if self.fields is None:
                while self.buffer.startswith(b"\r\n"):  # line ends between records
                    del self.buffer[:2]
                end = self.buffer.find(END)
                if end < 0:
                    return
                first, *lines = bytes(self.buffer[:end]).decode("utf-8", "replace").split("\r\n")
                if not first.startswith("WARC/"):
                    raise BrokenArchive(f"{self.file}: no record begins at {first[:40]!r}")
                self.fields = {n.strip(" \t").lower(): v.strip(" \t") for n, _, v in (x.partition(":") for x in lines)}
                del self.buffer[: end + len(END)]
                self.need = int(self.fields["content-length"]) + len(END)
            else:
                block = bytes(self.buffer[: self.need - len(END)])
                if self.buffer[self.need - len(END) : self.need] != END:
                    raise BrokenArchive(f"{self.file}: a record is longer than it says")
                del self.buffer[: self.need]
                yield self.fields, block
                self.fields, self.need = None, 0

    def close(self) -> None:
        if self.fields is not None or bytes(self.buffer).strip(b"\r\n"):
            raise BrokenArchive(f"{self.file} ends within a record")


def _decoded(kind: str, block: bytes | None, digest: str | None, problem: str | None, payload: bool) -> dict:
    """Payload, its length and digest, or what is wrong; a revisit has none of its own."""
    if kind == "revisit" or block is None:
        return {"problem": problem}
    try:
        body = http_payload(block)
    except BrokenArchive as broken:
        return {"problem": str(broken)}
    found = base64.b32encode(hashlib.sha1(body).digest()).decode()
    wrong = digest is not None and digest.removeprefix("sha1:") != found
    return {
        "payload": body if payload else None, "payload_bytes": len(body), "payload_digest": found,
        "problem": "the payload does not have its digest" if wrong else None,
    }


_FOUND = pa.schema([
    ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("problem", pa.string()),
])
_HEAD = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("id", pa.string()), ("url", pa.string()),
    ("refers", pa.string()), ("digest", pa.string()),
])
_SEGMENT = pa.schema([("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()), ("block", pa.binary())])
_DDL = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary"}


def _ddl(*schemas: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {_DDL[f.type]}" for s in schemas for f in s)


def parsed_records(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """One row per record of all archives; segments keep their block, other records are decoded."""
    schema = pa.schema([*_HEAD, *_SEGMENT, *_FOUND])
    pieces = spark.read.option("lineSep", END.decode()).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece")
    )

    def row(fields: dict[str, str], block: bytes) -> dict:
        def urn(name: str) -> str | None:
            value = fields.get(name)
            return value if value is None else value.strip("<>")

        own, number, total = fields.get("x-row-id"), fields.get("warc-segment-number"), fields.get("warc-segment-total-length")
        out = {
            "record_id": urn("warc-record-id"), "record_type": fields.get("warc-type"),
            "id": own if own is None else urllib.parse.unquote(own), "url": fields.get("warc-target-uri"),
            "refers": urn("warc-refers-to"), "digest": fields.get("warc-payload-digest"),
        }
        if number is None:
            return out | _decoded(out["record_type"], block, out["digest"], None, payload)
        out |= {"origin": urn("warc-segment-origin-id") or out["record_id"], "number": int(number), "block": block}
        return out | {"total": total if total is None else int(total)}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser: RecordParser | None = None
        out, size = [], 0
        for batch in batches:
            for file, piece in zip(batch.column("file").to_pylist(), batch.column("piece").to_pylist()):
                if parser is None or parser.file != file:
                    if parser is not None:
                        parser.close()
                    if not file.endswith(".gz"):
                        raise BrokenArchive(f"{file}: only gzip archives are read whole by one task")
                    parser = RecordParser(file)
                for fields, block in parser.feed(piece + END):
                    out.append(row(fields, block))
                    size += len(block) + 500
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
        if parser is not None:
            parser.close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return pieces.mapInArrow(parse, _ddl(_HEAD, _SEGMENT, _FOUND))


def reassembled(numbers: list[int], totals: list[int | None], blocks: list[bytes]) -> tuple[bytes | None, str | None]:
    """The whole block of one origin, or what is wrong with its segments."""
    order = sorted(range(len(numbers)), key=numbers.__getitem__)
    if [numbers[i] for i in order] != list(range(1, len(order) + 1)):
        return None, f"segments {sorted(numbers)[:9]} are not 1 to {len(order)}, once each"
    block = b"".join(blocks[i] for i in order)
    stated = totals[order[-1]]
    if stated != len(block):
        return None, f"segments of {len(block)} bytes, {stated} stated"
    return block, None


def whole_records(records: DataFrame, payload: bool = True) -> DataFrame:
    """Join the segments of :func:`parsed_records`: one row per record, as :data:`_HEAD` and :data:`_FOUND` say."""
    found = pa.struct(list(_FOUND))

    def join(kinds: pa.Array, digests: pa.Array, segments: pa.Array) -> pa.Array:
        out = []
        for kind, digest, parts in zip(kinds.to_pylist(), digests.to_pylist(), segments.to_pylist()):
            block, problem = reassembled(*[[p[c] for p in parts] for c in ("number", "total", "block")])
            out.append(_decoded(kind, block, digest, problem, payload))
        return pa.array(out, found)

    join.__annotations__ = {"kinds": pa.Array, "digests": pa.Array, "segments": pa.Array, "return": pa.Array}
    head = [f.name for f in _HEAD]
    first = F.first(F.when(F.col("number") == 1, F.struct(*head)), ignorenulls=True)
    # One group is one record, whose size bounds it.
    groups = records.filter("number is not null").groupBy("origin").agg(
        first.alias("head"), F.collect_list(F.struct("number", "total", "block")).alias("segments")
    ).select(F.coalesce("head.record_id", "origin").alias("record_id"), *[f"head.{c}" for c in head[1:]], "segments")
    joined = groups.withColumn("found", F.arrow_udf(join, _ddl(_FOUND))("record_type", "digest", "segments"))
    names = [*head, *[f.name for f in _FOUND]]
    return records.filter("number is null").select(*names).unionByName(joined.select(*head, "found.*").select(*names))


def read_archives(
    spark: SparkSession, folder: str, payload: bool = True, strict: bool = True
) -> DataFrame:
    """``id, url, record_type, payload_bytes, payload_digest, refers_to, problem[, payload]``, one row per record.

    Revisits take length and digest, and with ``payload`` the payload too, from the response they name;
    ``refers_to`` is its id. ``problem`` tells of gaps, wrong lengths, broken framing, wrong digests and
    revisits of absent records; with ``strict`` any of them fails the job.
    """
    records = stored(whole_records(parsed_records(spark, folder, payload), payload))
    revisit = F.col("record_type") == "revisit"
    body = ["payload"] if payload else []
    targets = records.filter(~revisit).select(
        F.col("record_id").alias("refers"), F.col("id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"),
        F.col("payload_digest").alias("_digest"), *[F.col(c).alias("_payload") for c in body], F.lit(True).alias("_met"),
    )
    revisits = records.filter(revisit).drop("payload_bytes", "payload_digest", "payload")
    counts = revisits.groupBy("refers").agg(F.count(F.lit(1)).alias("n"))
    joined = salted_join(revisits, targets, "refers", hot_keys(counts, "refers", "n"), "record_id", "left")
    stated = F.regexp_replace("digest", "^sha1:", "")
    problem = F.when(F.col("_met").isNull(), F.lit("revisit of an absent record")).when(
        ~stated.eqNullSafe(F.col("_digest")), F.lit("revisit of another payload")
    )
    names = ["id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "problem", *body]
    seen = joined.withColumns({
        "payload_bytes": F.col("_bytes"), "payload_digest": F.col("_digest"),
        "problem": F.coalesce("problem", problem), **({"payload": F.col("_payload")} if payload else {}),
    }).select(*names)
    own = records.filter(~F.coalesce(revisit, F.lit(False))).withColumn("refers_to", F.lit(None).cast("string"))
    out = own.select(*names).unionByName(seen)
    if not strict:
        return out
    message = F.concat(F.lit("record of row "), F.coalesce("id", F.lit("null")), F.lit(": "), F.col("problem"))
    return out.withColumn("problem", F.when(F.col("problem").isNotNull(), F.raise_error(message)).cast("string"))
