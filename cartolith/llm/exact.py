"""Exact duplicates with a heavy-hitter split; built-in expressions only.

Rows become (id, digest of the text without white space, code points). A Misra-Gries frequent-items sketch of bounded
size finds digests that stand out; their exact sizes and winners come from a map-side aggregate and are broadcast (at
most HEAVY rows), so rows of hot groups are decided where they are. All other digests are rarer than the sketch's
error and take an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartolith.runtime import materialize

SPACES = r"[\x20\x09-\x0D]+"
HEAVY, TRACKED = 256, 8192


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, digest (32 bytes), n_chars; null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(F.regexp_replace(text, SPACES, ""), 256)).alias("digest"), F.char_length(text).alias("n"))


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """id, keep_id, group_size, kept, text_sha256 for every row.

    Of rows with equal text (white space aside) the one with the most code points stays, then the smallest id; a null
    id stands last. kept means id = keep_id, so repeated rows of the winning id are all kept. Empty and null texts are
    one group. An empty table gives no rows.
    """
    rows = materialize(digest_rows(docs, id_col, text_col))
    top = rows.select(F.xxhash64("digest").alias("h")).agg(F.expr(f"approx_top_k(h, {heavy}, {tracked})").alias("top"), F.count("*").alias("total"))
    hot = top.select("total", F.inline("top").alias("h", "times")).where("times > 32 and times > total / 4096").select("h")
    order = F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("unknown"), "id")
    mine = rows.join(F.broadcast(hot), F.xxhash64("digest") == F.col("h"), "left_semi")
    won = materialize(mine.groupBy("digest").agg(F.min_by("id", order).alias("keep_id"), F.count("*").alias("group_size")))
    marked = rows.join(F.broadcast(won), "digest", "left")
    every = Window.partitionBy("digest").orderBy(F.desc("n"), F.asc_nulls_last("id")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = rows.join(F.broadcast(won.select("digest")), "digest", "left_anti")
    rest = rest.select("id", "digest", F.first("id").over(every).alias("keep_id"), F.count("*").over(every).alias("group_size"))
    both = marked.where("group_size is not null").select("id", "digest", "keep_id", "group_size").union(rest)
    return both.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that lose to an equal text; all columns. Rows without an id stay.

    A row goes by its id and its text's digest: where one id stands on several texts, only those that lose go.
    """
    lost = exact_groups(docs, id_col=id_col, text_col=text_col).where(~F.col("kept") & F.col(id_col).isNotNull())
    lost = lost.select(F.col(id_col).alias("lost_id"), F.unhex("text_sha256").alias("lost_digest"))
    digest = F.unhex(F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACES, ""), 256))
    return docs.join(lost, (F.col(id_col) == F.col("lost_id")) & (digest == F.col("lost_digest")), "left_anti").select(docs.columns)
