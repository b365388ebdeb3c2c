"""Removal of repeated runs of words by difference-cover anchors.

A word position is a cover position if its place modulo PERIOD is in COVER, whose differences give every remainder.
So any two equal windows of WIDTH words have an offset below PERIOD at which both are at cover positions, and the
anchor of WIDTH - PERIOD + 1 words there lies in both. Only anchors (4 of 13 positions) are counted over the corpus.
Windows around a repeated anchor are extended to full windows, whose 128-bit hashes are grouped with map-side minima:
each distinct window gives its first place, and every candidate that is not a first place is a repeat.

Which anchors repeat comes back as a bitmap over hash space of at most max_bitmap_bytes; it may have false positives,
which only cost a window. Above that size the repeated anchors are joined with the rows instead.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartolith.llm.bitmap import build
from cartolith.llm.words import U64, Chunk, chunks, windows
from cartolith.runtime import materialize, ship

WIDTH, PERIOD, COVER = 20, 13, (0, 1, 3, 9)


def _anchors(c: Chunk, width: int, period: int, cover: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and hash of each anchor in the chunk; word hashes are per chunk."""
    long = width - period + 1
    a, inside = windows(c.hashes(31), c.first, long, 32)
    row = np.repeat(np.arange(len(c.first) - 1), np.diff(c.first))[: len(a)]
    place = np.arange(len(a)) - c.first[row]
    at = np.flatnonzero(inside & np.isin(place % period, cover) & (c.first[row + 1] - c.first[row] >= width))
    return row[at], place[at], a[at]


def _candidates(c: Chunk, width: int, period: int, cover: tuple, repeated) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and two hashes of each window around a repeated anchor. repeated: (row, hash) -> bool."""
    row, place, a = _anchors(c, width, period, cover)
    hit = repeated(row, a)
    n = len(c.start) - width + 1
    if n <= 0 or not hit.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    at = c.first[row[hit]] + place[hit]
    edge = np.zeros(len(c.start) + period + 1, np.int64)
    np.add.at(edge, np.maximum(at - period + 1, c.first[row[hit]]), 1)
    np.add.at(edge, at + 1, -1)
    one, inside = windows(c.hashes(33), c.first, width, 34)
    two, _ = windows(c.hashes(35), c.first, width, 36)
    start = np.flatnonzero((np.cumsum(edge)[:n] > 0) & inside)
    r = np.searchsorted(c.first, start, side="right") - 1
    return r, start - c.first[r], one[start], two[start]


def _long(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64), pa.int64())


def repeated_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, period: int = PERIOD, cover: tuple = COVER, max_bitmap_bytes: int = 1 << 26) -> DataFrame:
    """id, n_words, n_removed, kept_text (kept words joined by one space) for every row.

    A word goes if a window of width words over it has equal words at an earlier start: a smaller id, or the same row
    and an earlier place. Null and empty texts have no words; rows with fewer than width words keep all. Rows with a
    null id keep all and count for nothing. Ids may be of any type that has an order. Rows with one id and one text are
    one document; those with one id and other texts are documents of their own, in the order of a hash of the text.
    """
    if width < period or {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("cover must give all differences modulo period, and a window must hold an anchor")
    spark = docs.sparkSession
    ship(spark)
    kind = dict(docs.dtypes)[id_col]
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    rows = docs.select((F.col(id_col).cast("long") if whole else F.col(id_col)).alias("id"), F.col(text_col).alias("text"))
    # a document is its id; where ids repeat, its id and a hash of its text
    repeats = not rows.where("id is not null").groupBy("id").count().where("count > 1").isEmpty()
    key = F.when(F.col("id").isNotNull(), F.struct("id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k"))) if repeats else F.col("id")
    rows = rows.select("id", key.alias("key"), "text")
    key_kind = dict(rows.dtypes)["key"]
    known = rows.where("id is not null")

    def anchors(batches):
        for b in batches:
            for c in chunks(b.column("text")):
                yield pa.RecordBatch.from_arrays([_long(_anchors(c, width, period, cover)[2])], ["h"])

    often = known.mapInArrow(anchors, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    often = materialize(often)
    count = often.count()
    sent = by_row = None
    if count * 4 <= max_bitmap_bytes:
        sent = spark.sparkContext.broadcast(build(often, count))
    else:
        by_row = _joined(known, often, width, period, cover)

    def of(batch: pa.RecordBatch, c: Chunk):
        if sent is not None:
            return sent.value
        own = batch.column("often").slice(c.rows.start, c.rows.stop - c.rows.start)
        sets = [set(np.frombuffer(x or b"", U64).tolist()) for x in own.to_pylist()]
        return lambda row, h: np.fromiter((x in sets[r] for r, x in zip(row.tolist(), h.tolist(), strict=True)), bool, len(h))

    source = known if by_row is None else by_row

    def places(batches):
        for b in batches:
            for c in chunks(b.column("text")):
                r, p, one, two = _candidates(c, width, period, cover, of(b, c))
                yield pa.RecordBatch.from_arrays([_long(one), _long(two), b.column("key").take(pa.array(r + c.rows.start)), pa.array(p, pa.int64())], ["h", "g", "key", "p"])

    found = source.mapInArrow(places, f"h long, g long, key {key_kind}, p long")
    # smallest (key, place): as one number where ids and places fit, so that map-side minima stay in a hash aggregate
    low, high, longest = known.agg(F.min("id"), F.max("id"), F.max(F.octet_length("text"))).first()
    bits = max(1, int(longest or 1).bit_length())
    if whole and not repeats and (low is None or (low >= 0 and int(high).bit_length() + bits < 63)):
        one = found.groupBy("h", "g").agg(F.min(F.shiftleft("key", bits) + F.col("p")).alias("at"))
        firsts = one.select(F.shiftright("at", bits).alias("key"), F.col("at").bitwiseAND((1 << bits) - 1).cast("int").alias("p"))
    else:
        one = found.groupBy("h", "g").agg(F.min(F.struct("key", "p")).alias("at"))
        firsts = one.select("at.key", F.col("at.p").cast("int").alias("p"))
    firsts = materialize(firsts.groupBy("key").agg(F.collect_list("p").alias("first")))
    work = rows if by_row is None else by_row.unionByName(rows.where("id is null"), allowMissingColumns=True)
    work = work.join(firsts, "key", "left")

    def remove(batches):
        for b in batches:
            first, n, gone, kept = b.column("first"), [], [], []
            known_id = b.column("key").is_valid().to_numpy(zero_copy_only=False)
            for c in chunks(b.column("text")):
                r, p, _, _ = _candidates(c, width, period, cover, of(b, c))
                start = c.first[r] + p
                again = np.zeros(len(c.start) + 1, bool)
                again[start] = True
                for k, own in enumerate(first.slice(c.rows.start, c.rows.stop - c.rows.start)):
                    if own.is_valid:
                        again[c.first[k] + own.values.to_numpy()] = False
                    if not known_id[c.rows.start + k]:
                        again[c.first[k] : c.first[k + 1]] = False
                edge = np.zeros(len(c.start) + width + 1, np.int64)
                at = np.flatnonzero(again)
                edge[at] += 1
                edge[at + width] -= 1
                cut = np.cumsum(edge)[: len(c.start)] > 0
                data = c.data.tobytes()
                for k in range(len(c.first) - 1):
                    span = slice(c.first[k], c.first[k + 1])
                    stay = np.flatnonzero(~cut[span]) + c.first[k]
                    n.append(int(c.first[k + 1] - c.first[k]))
                    gone.append(n[-1] - len(stay))
                    kept.append(b" ".join([data[s:e] for s, e in zip(c.start[stay].tolist(), c.end[stay].tolist(), strict=True)]))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "n_removed", "kept_text"])

    out = work.mapInArrow(remove, f"id {dict(rows.dtypes)['id']}, n_words long, n_removed long, kept_text string")
    return out.select(F.col("id").cast(kind).alias(id_col), "n_words", "n_removed", "kept_text")


def _joined(known: DataFrame, often: DataFrame, width: int, period: int, cover: tuple) -> DataFrame:
    """Rows with the hashes of their repeated anchors, by joins, for anchors beyond the bitmap's bound."""

    def anchors(batches):
        for b in batches:
            for c in chunks(b.column("text")):
                row, _, h = _anchors(c, width, period, cover)
                yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(row + c.rows.start)), _long(h)], ["key", "h"])

    kind = dict(known.dtypes)["key"]
    own = known.mapInArrow(anchors, f"key {kind}, h long").join(often, "h").groupBy("key").agg(F.collect_set("h").alias("hs"))

    def pack(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.array(x, np.int64).tobytes() for x in b.column(1).to_pylist()], pa.binary())], ["key", "often"])

    return materialize(known.join(own.mapInArrow(pack, f"key {kind}, often binary"), "key", "left").select("id", "key", "text", "often"))


def kept_digests(docs: DataFrame, *, id_col: str = "doc_id", **named) -> DataFrame:
    """repeated_runs() with a digest in place of the text."""
    return repeated_runs(docs, id_col=id_col, **named).select(id_col, "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]], width: int = WIDTH) -> dict[int, tuple[int, int, str]]:
    """The same result by plain Python, for tests: id -> (n_words, n_removed, kept digest)."""
    import re

    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    seen: set[tuple] = set()
    out = {}
    for i in sorted(words):
        w, cut = words[i], set()
        for p in range(len(w) - width + 1):
            run = tuple(w[p : p + width])
            if run in seen:
                cut.update(range(p, p + width))
            seen.add(run)
        kept = " ".join(x for k, x in enumerate(w) if k not in cut)
        out[i] = (len(w), len(cut), hashlib.sha256(kept.encode()).hexdigest())
    return out
