"""Near duplicates: MinHash signatures, a multi-index Hamming join, exact confirmation.

A row's set is its distinct shingles of five words. Rows with equal sets are one class, found by a 128-bit digest of
the set; only one row of each class goes on. A signature has 64 symbols of 16 bits (the low bits of 64 minima). It is
split into 12 chunks, so that two signatures that differ in at most 23 symbols have a chunk with at most one
difference (pigeonhole); all ways of one error in a chunk are enumerated as keys with that symbol left out, 64 keys
a row. At similarity 0.85 the number of differing symbols is binomial (64, 0.15), so 24 or more have a chance of
about 9e-6. Every pair at or under the distance shares a key. For another similarity the number of
chunks, and with it the distance, follows from the same chance of a miss (parts_for).

Pairs inside a bucket are not all made: each member is compared with the bucket's smallest id, links are confirmed on
the full sets, and components follow. Buckets that still hold several components go through ROUNDS more hubs, each
drawn by a hash, whose exact distances to the members both link and are kept. What is then left is compared in pairs
of different components, without those that cannot be linked: 1 - similarity is a metric, so two members whose
distances to any hub differ by more than the limit are too far apart. A pair whose signatures differ in more than
ERRORS symbols is no candidate. Nor is one whose odd sketches differ in more places than the sets of a linked pair
can: bit i of a sketch of 1024 bits is the parity of the set's elements dealt to i, so that a differing bit needs an
element that only one of the sets has. That bound is exact, and near to the true difference for sets of up to some
thousand shingles; for longer ones it lets more pairs through. No component of candidates can be missed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolith.llm.bitmap import build
from cartolith.llm.words import U64, Chunk, chunks, constants, mix, windows
from cartolith.operators.graph import connected_components
from cartolith.runtime import materialize, ship, temporary

SHINGLE, SYMBOLS, CHUNKS = 5, 64, 12
ERRORS = 2 * CHUNKS - 1
PERCENT = 85
ROUNDS = 2
#: Bytes of text whose hashes are in memory at once
PIECE = 1 << 18
#: The largest bitmap of involved rows that is broadcast
MAP_BYTES = 1 << 26
#: Keys that one task makes and aggregates at a time, whatever the size of the files that signatures come from
TASK_KEYS = 1 << 19
#: The largest chance that two signatures of a linked pair differ in more symbols than the keys allow for
MISS = 9e-6
_FACTORS = constants(SYMBOLS, 41)
_KEY = constants(SYMBOLS, 42)


def miss(percent: int, parts: int) -> float:
    """The chance that a pair at this similarity differs in 2 * parts symbols or more."""
    p = 1 - percent / 100
    return sum(comb(SYMBOLS, k) * p**k * (1 - p) ** (SYMBOLS - k) for k in range(2 * parts, SYMBOLS + 1))


def parts_for(percent: int) -> int:
    """The least number of chunks at which miss() is within MISS: CHUNKS at PERCENT; chunks keep two symbols or more."""
    for parts in range(1, SYMBOLS // 2 + 1):
        if miss(percent, parts) <= MISS:
            return parts
    raise ValueError(f"{SYMBOLS} symbols are too few for a similarity of {percent} %")


def chunk_limits(symbols: int = SYMBOLS, parts: int = CHUNKS) -> list[tuple[int, int]]:
    ends = [round(symbols * k / parts) for k in range(parts + 1)]
    return list(zip(ends, ends[1:], strict=False))


def shingle_sets(c: Chunk) -> list[np.ndarray]:
    """Each row's sorted distinct shingle hashes; a row with fewer words than a shingle has its whole sequence."""
    h = c.hashes(43, lower=True)
    s, _ = windows(h, c.first, SHINGLE, 44)
    out = []
    for a, b in zip(c.first[:-1].tolist(), c.first[1:].tolist(), strict=True):
        n = b - a
        if n >= SHINGLE:
            out.append(np.unique(s[a : b - SHINGLE + 1]))
        elif n:
            out.append(mix((h[a:b] * constants(n, 45)).sum(dtype=U64, keepdims=True) + U64(n)))
        else:
            out.append(np.zeros(0, U64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SYMBOLS 16-bit symbols for each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    for j in range(SYMBOLS):
        low = np.minimum.reduceat(mix_light(flat * _FACTORS[j]), starts)
        out[:, j] = (mix(low) & U64(0xFFFF)).astype(np.uint16)
    return out


def mix_light(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> U64(32))


def row_keys(sig: np.ndarray, chunk_count: int = CHUNKS) -> np.ndarray:
    """SYMBOLS keys for each signature: its chunks, each with one symbol left out."""
    parts = (sig.astype(U64) + U64(1)) * _KEY
    parts = mix(parts)
    out = np.empty(sig.shape, U64)
    for k, (a, b) in enumerate(chunk_limits(parts=chunk_count)):
        total = parts[:, a:b].sum(1, dtype=U64)
        for j in range(a, b):
            out[:, j] = mix(total - parts[:, j] + U64(1000 * k + j + 1))
    return out


def set_digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of hashes."""
    one, two = (int(mix(s + U64(k)).sum(dtype=U64).view(np.int64)) for k in (7, 8))
    return one, two


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n (set size), s1 and s2 (digest of the set), sig (empty set: null)."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            for c in chunks(b.column(1), PIECE):
                sets = shingle_sets(c)
                n = np.array([len(s) for s in sets])
                some = [s for s in sets if len(s)]
                sig = signatures(some) if some else np.zeros((0, SYMBOLS), np.uint16)
                digest = iter([r.astype("<u2").tobytes() for r in sig])
                sums = [set_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(c.rows.start, len(sets)), pa.array(n, pa.int64()), *(pa.array([x[k] for x in sums], pa.int64()) for k in (0, 1)), pa.array([next(digest) if k else None for k in n], pa.binary())],
                    ["id", "n", "s1", "s2", "sig"],
                )

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n long, s1 long, s2 long, sig binary")


def _keys(batches, chunk_count: int = CHUNKS, rows: int = 2048):
    for whole in batches:
        for lo in range(0, whole.num_rows, rows):
            b = whole.slice(lo, rows)
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), "<u2").reshape(-1, SYMBOLS)
            take = pa.array(np.repeat(np.arange(b.num_rows), SYMBOLS))
            yield pa.RecordBatch.from_arrays([pa.array(row_keys(sig, chunk_count).reshape(-1).view(np.int64)), b.column("id").take(take)], ["key", "id"])


def keys_of(reps: DataFrame, chunk_count: int = CHUNKS) -> DataFrame:
    """key, id: all keys of the rows (id, sig), dealt out so that a task makes about TASK_KEYS.

    A row of 128 bytes becomes SYMBOLS keys, nearly all of them different: a task's aggregate would hold some 30 times
    the bytes that it read.
    """
    tasks = -(-reps.count() * SYMBOLS // TASK_KEYS) or 1
    return reps.select("id", "sig").repartition(tasks).mapInArrow(partial(_keys, chunk_count=chunk_count), f"key long, id {dict(reps.dtypes)['id']}")


def _sets(batches, wanted=None):
    """id, digest, set and sketch of the rows of (id, text, h) whose h is in wanted."""
    for b in batches:
        if wanted is not None:
            h = b.column("h").to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
            b = b.filter(pa.array(wanted(None, h)))
        for c in chunks(b.column("text"), PIECE):
            sets = shingle_sets(c)
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            odd = np.stack([odd_sketch(s) for s in sets])
            sums = [set_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id").slice(c.rows.start, len(sets)),
                    *(pa.array([x[k] for x in sums], pa.int64()) for k in (0, 1)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64))),
                    *(pa.array(np.ascontiguousarray(odd[:, k])) for k in range(len(SKETCH))),
                ],
                ["id", "s1", "s2", "s", *SKETCH],
            )


def odd_sketch(s: np.ndarray) -> np.ndarray:
    """The parities of how many elements of s are dealt to each of 1024 places, as numbers of 64 bits."""
    odd = np.bincount((mix(s ^ U64(46)) & U64(64 * len(SKETCH) - 1)).astype(np.int64), minlength=64 * len(SKETCH)) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def too_far(a: str, b: str, n_a: Column, n_b: Column, percent: int) -> Column:
    """The sketches with these suffixes differ in more places than a linked pair of sets of these sizes can."""
    differ = sum((F.bit_count(F.col(f"{q}{a}").bitwiseXOR(F.col(f"{q}{b}"))).cast("int") for q in SKETCH), F.lit(0))
    return differ * F.lit(100 + percent) > F.lit(100 - percent) * (n_a + n_b)


LANES = [f"w{k}" for k in range(SYMBOLS // 4)]
SKETCH = [f"q{k}" for k in range(16)]


def _words(batches):
    """id, n and the signature as numbers of four lanes of 15 bits; a lane has a symbol's low 14 bits and a spare one."""
    for b in batches:
        if b.num_rows:
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), "<u2").reshape(-1, SYMBOLS // 4, 4).astype(np.int64) & 0x3FFF
            packed = (sig << (15 * np.arange(4))).sum(2)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n"), *(pa.array(np.ascontiguousarray(packed[:, k])) for k in range(len(LANES)))], ["id", "n", *LANES])


def lane_errors(a: Column, b: Column) -> Column:
    """In how many of their four lanes two numbers differ: a lane that isn't 0 carries into its spare bit."""
    every = lambda x: F.lit(sum(x << (15 * j) for j in range(4)))
    return F.bit_count((a.bitwiseXOR(b) + every(0x3FFF)).bitwiseAND(every(0x4000))).cast("int")


def _linked(n_a: Column, n_b: Column, common: Column, percent: int) -> Column:
    return F.lit(100) * common >= F.lit(percent) * (n_a + n_b - common)


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with n_a, n_b and the size of what their full sets share."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    return both.select("a", "b", F.size("sa").alias("n_a"), F.size("sb").alias("n_b"), F.size(F.array_intersect("sa", "sb")).alias("common"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    return distances(pairs, sets).where(_linked(F.col("n_a"), F.col("n_b"), F.col("common"), percent)).select("a", "b")


def _components(links: DataFrame) -> DataFrame:
    """c, c2: the component that links (a, b) give each of their ends."""
    return materialize(connected_components(links).select(F.col("node").alias("c"), F.col("component").alias("c2")))


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of the buckets that still hold several components."""
    keys = materialize(rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key"))
    return materialize(rows.join(keys, "key"))


def _full_sets(docs: DataFrame, node: Callable, involved: DataFrame, repeats: bool) -> DataFrame:
    """id (node), s, sketch of the involved nodes, and maybe of a few others.

    Without repeated ids a bitmap of the nodes goes to the texts, so that these do not move; beyond MAP_BYTES, or where
    ids repeat, they are joined. The texts of one row or another are the same here: the set is the node's own.
    """
    spark, kind = docs.sparkSession, dict(docs.dtypes)["id"]
    schema = f"id {kind}, s1 long, s2 long, s array<long>, " + ", ".join(f"{q} long" for q in SKETCH)
    own = docs.select("id", "text", F.xxhash64("id").alias("h"))
    count = involved.count()
    if not repeats and 4 * count <= MAP_BYTES:
        wanted = spark.sparkContext.broadcast(build(involved.select(F.xxhash64("id").alias("h")), count))
        own = own.mapInArrow(lambda it: _sets(it, wanted.value), schema)
    else:
        ids = involved.select(F.col("id.id") if repeats else F.col("id")).distinct()
        own = own.join(ids, "id", "left_semi").mapInArrow(_sets, schema)
    own = own.where("size(s) > 0").select(node().alias("id"), "s", *SKETCH)
    return materialize(own.dropDuplicates(["id"]) if repeats else own)


def _component_of_classes(docs: DataFrame, rows: DataFrame, percent: int, rounds: int, repeats: bool) -> tuple[DataFrame, DataFrame]:
    """(classes, nodes): n, s1, s2, rep, top for each distinct set; and node, component for each of their reps that may have links.

    A node is a class's smallest id. Where ids repeat, one id may stand for several sets, and a node is that id with
    the set's digest.
    """
    parts = parts_for(percent)
    errors = 2 * parts - 1
    node = (lambda: F.struct("id", "s1", "s2")) if repeats else (lambda: F.col("id"))
    full = rows.where("id is not null and n > 0").withColumn("id", node())
    kind = dict(full.dtypes)["id"]
    # one row for each distinct set; the signature follows from the set
    classes = materialize(full.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.max("id").alias("top")))
    reps = full.join(classes.select(F.col("rep").alias("id"), "n", "s1", "s2"), ["id", "n", "s1", "s2"])
    reps = materialize((reps.dropDuplicates(["id"]) if repeats else reps).select("id", "n", "sig"))
    keys = keys_of(reps, parts)
    hubs = materialize(keys.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("many")).where("many > 1").select("key", "hub"))
    members = materialize(keys.join(hubs, "key"))
    involved = materialize(members.select("id").distinct())
    sets = _full_sets(docs, node, involved, repeats)
    n = lambda x: reps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"))
    stars = members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    stars = materialize(stars.join(n("a"), "a").join(n("b"), "b").where(_near(F.col("n_a"), F.col("n_b"), percent)).select("a", "b"))
    comp = _components(confirmed(stars, sets, percent))
    maps = [comp]
    # buckets that still hold several components
    left = members.select("key", "id").join(comp.select(F.col("c").alias("id"), "c2"), "id", "left")
    left = _mixed(materialize(left.select("key", "id", F.coalesce("c2", "id").alias("c"), F.array().cast("array<double>").alias("ds"))))
    for k in range(rounds):
        if left.isEmpty():
            break
        own = materialize(left.groupBy("key").agg(F.min_by("id", F.xxhash64("id", F.lit(k))).alias("hub")))
        with_hub = materialize(left.join(own, "key"))
        far = distances(with_hub.where("hub <> id").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), sets)
        far = materialize(far.select("a", "b", _linked(F.col("n_a"), F.col("n_b"), F.col("common"), percent).alias("ok"), (1 - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))).alias("d")))
        place = materialize(left.select("id", "c").distinct())
        links = far.where("ok").join(place.select(F.col("id").alias("a"), F.col("c").alias("c_a")), "a").join(place.select(F.col("id").alias("b"), F.col("c").alias("c_b")), "b")
        maps.append(_components(links.where("c_a <> c_b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b")).distinct()))
        # components are looked up once for each node, not for each of its buckets; distances and they travel together
        moved = materialize(place.join(maps[-1], "c").select(F.col("id").alias("b"), "c2"))
        hubs_too = own.select(F.col("hub").alias("a"), F.col("hub").alias("b"), F.lit(0.0).alias("d")).distinct()
        reached = far.select("a", "b", "d").union(hubs_too).join(moved, "b", "left")
        known = with_hub.join(reached, (F.col("hub") == F.col("a")) & (F.col("id") == F.col("b")), "left")
        left = _mixed(materialize(known.select("key", "id", F.coalesce("c2", "c").alias("c"), F.concat("ds", F.array(F.coalesce("d", F.lit(0.0)))).alias("ds"))))
    if not left.isEmpty():
        # only here do signatures and sketches travel, with the rows of buckets that are still mixed
        lanes = reps.select("id", "n", "sig").join(left.select("id").distinct(), "id", "left_semi").mapInArrow(_words, f"id {kind}, n long, " + ", ".join(f"{w} long" for w in LANES))
        sg = materialize(lanes.join(sets.select("id", *SKETCH), "id"))
        left = materialize(left.join(sg, "id"))
        a, b = (left.select("key", *[F.col(x).alias(f"{x}_{side}") for x in ("id", "n", "c", "ds", *LANES, *SKETCH)]) for side in "ab")
        apart = F.exists(F.zip_with("ds_a", "ds_b", lambda x, y: F.abs(x - y)), lambda x: x > 1 - percent / 100 + 1e-9)
        differ = sum((lane_errors(F.col(f"{w}_a"), F.col(f"{w}_b")) for w in LANES), F.lit(0))
        may = (F.col("id_a") < F.col("id_b")) & (F.col("c_a") != F.col("c_b")) & _near(F.col("n_a"), F.col("n_b"), percent)
        more = a.join(b, "key").where(may & (differ <= errors) & ~too_far("_a", "_b", F.col("n_a"), F.col("n_b"), percent) & ~apart)
        more = materialize(more.groupBy(F.col("id_a").alias("a"), F.col("id_b").alias("b")).agg(F.first("c_a").alias("c_a"), F.first("c_b").alias("c_b")))
        extra = confirmed(more, sets, percent).join(more, ["a", "b"]).select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
        maps.append(_components(extra.distinct()))
    # nodes that share no bucket have no link
    every = classes.select(F.col("rep").alias("id")) if repeats else involved
    out = every.select(F.col("id").alias("node"), F.col("id").alias("c"))
    for one in maps:
        out = out.join(one, "c", "left").select("node", F.coalesce("c2", "c").alias("c"))
    if repeats:
        # sets that share an id are one document
        out = materialize(out)
        named = full.select(F.col("id.id").alias("own"), "n", "s1", "s2").distinct().join(classes.select("n", "s1", "s2", F.col("rep").alias("node")), ["n", "s1", "s2"]).join(out, "node").select("own", "c").distinct()
        first = materialize(named.groupBy("own").agg(F.min("c").alias("a"), F.max("c").alias("last")).where("a < last").select("own", "a"))
        shared = _components(named.join(first, "own").where("c <> a").select("a", F.col("c").alias("b")).distinct())
        out = out.join(shared, "c", "left").select("node", F.coalesce("c2", "c").alias("c"))
    return classes, materialize(out.withColumnRenamed("c", "component"))


def near_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """id, n_shingles, component_id, kept: one row for every row; linked where 100 * |A and B| >= percent * |A or B|.

    component_id is the smallest id reachable over links, itself included. Empty sets are linked with nothing but rows
    of their own id. Rows that share an id are one document, whatever their texts: what any of them is linked with is
    one component. A row with a null id is its own component and kept.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    with temporary(spark) as keep:
        rows = materialize(profiles(docs, "id", "text"))
        repeats = not rows.where("id is not null").groupBy("id").count().where("count > 1").isEmpty()
        classes, comp = _component_of_classes(docs, rows, percent, rounds, repeats)
        label = (lambda x: F.col(f"{x}.id")) if repeats else F.col
        of_class = classes.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left").select("n", "s1", "s2", label("rep").alias("rep"), label("top").alias("top"), F.coalesce(label("component"), label("rep")).alias("c"))
        # classes of one row and no link need no join: their row is its own component
        of_class = materialize(of_class.where("rep < top or c <> rep").select("n", "s1", "s2", "c"))
        out = rows.select("id", "n", "s1", "s2").join(of_class, ["n", "s1", "s2"], "left").select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("c")), "id")).alias("c"))
        if repeats:
            own = materialize(out.groupBy("id").agg(F.min("c").alias("least")))
            out = out.join(own, "id", "left").select("id", "n", F.coalesce("least", "c").alias("c"))
        out = keep(out)
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("c").alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _near(n_a: Column, n_b: Column, percent: int) -> Column:
    """Sizes at which the similarity can be reached at all."""
    return F.lit(100) * F.least(n_a, n_b) >= F.lit(percent) * F.greatest(n_a, n_b)


def drop_near(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """docs without the rows that are not the first of their component; all columns. Rows without an id stay.

    Rows that share an id are one document here: where one of them goes, all do, whatever their texts.
    """
    lost = near_groups(docs, id_col=id_col, text_col=text_col, percent=percent).where(~F.col("kept") & F.col(id_col).isNotNull()).select(id_col)
    return docs.join(lost, id_col, "left_anti").select(docs.columns)


def brute_force(rows: list[tuple[int, str | None]], percent: int = PERCENT) -> dict[int, tuple[int, int]]:
    """id -> (set size, component) by comparing all pairs, for tests."""
    import re

    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                comp[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}
