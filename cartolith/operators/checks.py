"""Validation: rules as expressions over one table, or between tables, giving one row for each violation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolith.functions import ids
from cartolith.operators import tables

def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) for each rule that a row breaks, in one pass; a rule that is null holds."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]))
    return df.select(F.col(key).cast("string").alias("key"), F.explode(broken).alias("rule"))


def id_rules(key: Column, level: str | None = None) -> dict[str, Column]:
    """An id is there, follows the general grammar, and that of its level."""
    out = {"empty_id": key.isNotNull() & (key != ""), "bad_id": (key == "") | ids.id_ok(key)}
    return out | ({f"not_a_{level}_id": (key == "") | ids.id_ok(key, level)} if level else {})


def duplicate_violations(df: DataFrame, key: str, rule: str) -> DataFrame:
    return tables.duplicates(df, key).select(F.col(key).cast("string").alias("key"), F.lit(rule).alias("rule"))


def orphan_violations(child: DataFrame, key: str, parent: DataFrame, parent_key: str, rule: str) -> DataFrame:
    """Values of key that no parent has; null and empty ones are no reference."""
    lost = tables.orphans(child.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")), key, parent, parent_key)
    return lost.select(F.col(key).cast("string").alias("key"), F.lit(rule).alias("rule")).distinct()


def pair_violations(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges without an end, to themselves, or given twice in either direction."""
    ends = edges.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
    named = F.concat_ws("|", F.least("a", "b"), F.greatest("a", "b"))
    single = violations(ends.withColumn("key", named), "key", {"no_end": F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != "") & (F.col("b") != ""), "self_loop": F.col("a") != F.col("b")})
    twice = ends.where("a is not null and b is not null").groupBy(named.alias("key")).count().where("count > 1").select("key", F.lit("duplicate_pair").alias("rule"))
    return single.union(twice)


def hierarchy_violations(groups: DataFrame, phrases: tuple[str, ...], known: DataFrame, most: int = 5) -> DataFrame:
    """(key, rule) for groups (id, basis, sources, members): what a historical region must have.

    A basis without convenience phrases, web sources, members that are there once, in one group only, of one country
    (the part of a member before __) and that known (id) has, itself or as a prefix before _. Sizes of 1 or above most
    are warnings.
    """
    url = r"^https?://[^/?#\s]+"
    basis = F.lower(F.trim(F.coalesce("basis", F.lit(""))))
    size = F.size(F.coalesce("members", F.array().cast("array<string>")))
    rules = {
        "empty_id": F.trim(F.coalesce("id", F.lit(""))) != "",
        "no_basis": basis != "",
        "convenience_basis": ~F.greatest(*[F.contains(basis, F.lit(p)).cast("int") for p in phrases], F.lit(0)).cast("boolean"),
        "no_sources": F.size(F.coalesce("sources", F.array().cast("array<string>"))) > 0,
        "bad_source": ~F.exists("sources", lambda s: ~F.coalesce(F.trim(s).rlike(url), F.lit(False))),
        "no_members": size > 0,
        "repeated_member": F.size(F.array_distinct("members")) == size,
        "mixed_countries": F.size(F.array_distinct(F.transform(F.filter("members", lambda m: F.contains(m, F.lit("__"))), lambda m: F.substring_index(m, "__", 1)))) <= 1,
        "warning_single": F.size(F.array_distinct("members")) != 1,
        "warning_large": F.size(F.array_distinct("members")) <= most,
    }
    own = violations(groups, "id", rules)
    member = groups.select("id", F.explode("members").alias("m")).distinct()
    twice = member.groupBy("m").agg(F.count("*").alias("n")).where("n > 1").select(F.col("m").alias("key"), F.lit("two_owners").alias("rule"))
    names = known.select(F.explode(ids.prefixes(F.col("id"))).alias("m")).distinct()
    lost = member.select("m").distinct().join(names, "m", "left_anti").select(F.col("m").alias("key"), F.lit("unknown_member").alias("rule"))
    return own.union(duplicate_violations(groups, "id", "duplicate_id")).union(twice).union(lost)


def document_violations(spark, documents: dict[str, bool], versioned: tuple[str, ...] = ()) -> DataFrame:
    """(key, rule) for paths that are not there (required: true, else a warning) or lack a schema_version where one is due."""
    jvm, found = spark._jvm, []
    for path, needed in documents.items():
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            found.append((path, "missing" if needed else "warning_missing"))
        elif any(part in path for part in versioned) and "schema_version" not in spark.read.option("multiLine", True).json(path).columns:
            found.append((path, "no_schema_version"))
    return spark.createDataFrame(found, "key string, rule string")


def scenario_violations(states: DataFrame, provinces: DataFrame, forbidden: tuple[str, ...]) -> DataFrame:
    """(key, rule) for states (province_id, raw json): empty, unknown and repeated provinces, and forbidden fields."""
    fields = F.map_keys(F.from_json("raw", "map<string,string>"))
    own = violations(states, "province_id", {"empty_province_id": F.trim(F.coalesce("province_id", F.lit(""))) != "", "forbidden_field": ~F.arrays_overlap(F.coalesce(fields, F.array().cast("array<string>")), F.array(*map(F.lit, forbidden)))})
    return own.union(orphan_violations(states, "province_id", provinces, "id", "unknown_province")).union(duplicate_violations(states, "province_id", "duplicate_province_id"))
