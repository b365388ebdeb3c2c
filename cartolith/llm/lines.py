"""Removal of repeated multi-line chunks; built-in expressions only.

A row's text is cut at line ends. A rolling hash (a polynomial modulo PRIME) over the hashes of the last `window` lines
chooses chunk boundaries (where it is 0 modulo `period`), so the boundaries move with the content and a passage that was
shifted by other lines is cut in the same places. Within a run of one repeated line every place is a boundary. Of
boundaries that stand side by side every other one counts, from the first, so that only a text's last chunk can be a
single line. Chunks of `least_lines` lines or more are counted over the whole table by a 64-bit digest. What moves then
is narrow: places and digests, until each row gets the list of its repeated chunks, and its text is written once with
that list. The bytes of repeated chunks are compared there; where chunks of one digest differ, their groups are formed
anew by the bytes. All but the first place (smallest id, then position) of equal chunks go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolith.runtime import drop_materialized, materialize

WINDOW, PERIOD, LEAST_LINES = 2, 3, 2
PRIME, BASE = (1 << 31) - 1, 1_000_003
_NOT_BLANK = r"[^\x20\x09-\x0D]"


def pinned(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with one more column, computed once for each row: the optimizer doesn't copy it into later lambdas."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def line_hash(line: Column) -> Column:
    """The first 28 bits of a line's MD5 as a number; a hash that SQL engines share."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def with_chunks(df: DataFrame, text: Column, window: int = WINDOW, period: int = PERIOD) -> DataFrame:
    """df with the text's chunks, in order, as array of struct(lines, body); joined by line ends they are the text."""
    df = pinned(df, "lines", F.split(text, "\n", -1))
    df = pinned(df, "hashes", F.transform("lines", line_hash))
    rolled = F.col("hashes")
    for back in range(1, window):
        before = F.concat(F.array_repeat(F.lit(0).cast("long"), back), "hashes")
        rolled = F.zip_with(rolled, F.slice(before, 1, F.size("hashes")), lambda a, b: (a * BASE + b) % PRIME)
    df = pinned(df, "rolled", rolled)
    chosen = lambda h, i: (i > 0) & ((h % period == 0) | (F.get("lines", i) == F.get("lines", i - 1)))
    marks = F.array_join(F.transform("rolled", lambda h, i: F.when(chosen(h, i), F.lit("1")).otherwise(F.lit("0"))), "")
    df = pinned(df, "marks", F.regexp_extract_all(F.regexp_replace(marks, "11", "10"), F.lit("[01]"), F.lit(0)))
    ends = F.array_compact(F.transform("marks", lambda m, i: F.when(m == "1", i + 1)))
    df = pinned(df, "ends", F.array_union(ends, F.array(F.size("lines"))))
    df = pinned(df, "begins", F.concat(F.array(F.lit(0)), F.slice("ends", 1, F.size("ends") - 1)))
    body = lambda a, b: F.array_join(F.slice("lines", a + 1, b - a), "\n")
    df = pinned(df, "chunks", F.zip_with("begins", "ends", lambda a, b: F.struct((b - a).alias("lines"), body(a, b).alias("body"))))
    return df.drop("lines", "hashes", "rolled", "marks", "ends", "begins")


def _places(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Of each group of equal keys with several places the first one: keys, id0, k0, p0."""
    firsts = cells.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.struct("id", "k", "pos")).alias("at")).where("n > 1")
    return firsts.select(*keys, F.col("at.id").alias("id0"), F.col("at.k").alias("k0"), F.col("at.pos").alias("p0"))


_LATER = "not (id = id0 and k = k0 and pos = p0)"


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, period: int = PERIOD, least_lines: int = LEAST_LINES, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """id, n_lines, n_removed, kept_text for every row.

    Null and empty texts have one empty line; chunks of white space alone stay, and so does everything in an empty
    table. Rows without an id keep everything and do not count. Rows with one id and one text are one document; those
    with one id and other texts are documents of their own, in the order of a hash of the text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("t"), F.xxhash64(text).alias("k"))
    cells = with_chunks(rows.where("id is not null"), F.col("t"), window, period)
    cells = cells.select("id", "k", F.posexplode("chunks").alias("pos", "c")).where((F.col("c.lines") >= least_lines) & F.col("c.body").rlike(_NOT_BLANK))
    cells = materialize(cells.select("id", "k", "pos", digest(F.col("c.body")).alias("h")))
    firsts = materialize(_places(cells, ["h"]))
    again = cells.join(firsts, "h").select("id", "k", "pos", F.expr(_LATER).alias("later"))
    lists = again.groupBy("id", "k").agg(F.array_sort(F.collect_set("pos")).alias("again"), F.array_sort(F.collect_set(F.when(F.col("later"), F.col("pos")))).alias("gone"))
    # the text moves once, to the list of its repeated chunks
    full = materialize(rows.join(lists, ["id", "k"], "left"))
    bodies = with_chunks(full.where("again is not null"), F.col("t"), window, period).select("id", "k", "chunks", F.explode("again").alias("pos"))
    bodies = bodies.select("id", "k", "pos", F.get("chunks", F.col("pos"))["body"].alias("body")).withColumn("h", digest(F.col("body")))
    mixed = materialize(bodies.select("h", "body").distinct().groupBy("h").count().where("count > 1").select("h"))
    if not mixed.isEmpty():
        apart = materialize(bodies.join(mixed, "h"))
        true = apart.join(_places(apart, ["h", "body"]), ["h", "body"], "left").select("id", "k", "pos", F.expr(f"coalesce({_LATER}, false)").alias("later"))
        true = true.groupBy("id", "k").agg(F.collect_set("pos").alias("all"), F.collect_set(F.when(F.col("later"), F.col("pos"))).alias("true"))
        right = F.array_sort(F.array_union(F.array_except("gone", "all"), "true"))
        full = full.join(true, ["id", "k"], "left").withColumn("gone", F.when(F.col("all").isNull(), F.col("gone")).otherwise(right))
    drop_materialized(cells, firsts)
    out = with_chunks(full, F.col("t"), window, period).select("id", "gone", "chunks")
    # what stands between one removed chunk and the next
    begins = F.concat(F.array(F.lit(0)), F.transform("gone", lambda g: g + 1))
    stay = F.flatten(F.zip_with(begins, F.concat("gone", F.array(F.size("chunks"))), lambda a, b: F.slice("chunks", a + 1, b - a)))
    count = lambda a: F.aggregate(a, F.lit(0), lambda s, c: s + c["lines"])
    out = pinned(out.select("id", "chunks", count(F.col("chunks")).alias("n_lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone")), "kept", stay)
    kept_text = F.array_join(F.transform("kept", lambda c: c["body"]), "\n")
    return out.select(F.col("id").alias(id_col), F.col("n_lines").cast("long"), (F.col("n_lines") - count(F.col("kept"))).cast("long").alias("n_removed"), kept_text.alias("kept_text"))
