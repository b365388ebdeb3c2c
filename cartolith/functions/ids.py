"""Column expressions on names, ids and stable hashes."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def slug(name: Column) -> Column:
    """Lower-case ASCII letters and digits with single underscores; letters beyond ASCII are separators."""
    s = F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(s == "", F.lit("unnamed")).otherwise(s)


def name_key(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), r"\s+", " "))


# The grammar of ids, and those of the levels that have one of their own.
GENERAL_ID = r"^[a-z][a-z0-9_]*(?::[a-z0-9_]+)*$"
LEVEL_IDS = {
    "province": r"^province:[0-9]+$",
    "region": r"^region:[a-z0-9_]+:[a-z0-9_]+$",
    "macroregion": r"^macroregion:[a-z0-9_]+$",
    "water_cell": r"^water_cell:[0-9]+$",
    "water_area": r"^water_area:[a-z0-9_]+(?::[a-z0-9_]+)*$",
    "water_transition": r"^water_transition:[0-9]+$",
    "water_land_link": r"^water_land_link:[0-9]+$",
}


def id_ok(key: Column, level: str | None = None) -> Column:
    """Whether an id follows the general grammar, or its level's."""
    return key.rlike(LEVEL_IDS[level] if level else GENERAL_ID)


def djb2(s: Column) -> Column:
    """32-bit multiply-by-33 hash over characters."""
    return F.aggregate(F.split(s, ""), F.lit(5381).cast("long"), lambda h, c: F.when(c == "", h).otherwise((h * 33 + F.ascii(c)) % (1 << 32)))


def fnv_noise(s: Column) -> Column:
    """FNV-1a over characters, scaled to -1..1."""
    step = lambda h, c: F.when(c == "", h).otherwise(h.bitwiseXOR(F.ascii(c).cast("long")) * 16777619 % (1 << 32))
    return F.aggregate(F.split(s, ""), F.lit(2166136261).cast("long"), step) / F.lit(float(0xFFFFFFFF)) * 2 - 1


def md5_unit(s: Column) -> Column:
    """First 8 hex digits of the MD5 as a number in 0..1."""
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("double") / F.lit(float(0xFFFFFFFF))


def prefixes(key: Column, sep: str = "_") -> Column:
    """All prefixes of a key that end before a separator, and the key."""
    parts = F.split(key, sep)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), sep))


# How Cyrillic letters are spelt; hard and soft signs go, and capitals that are not listed separate.
LETTERS = ("ГАКНЛМСЭВБабвгдезийклмнопрстуфхцыэьъ", "gaknlmsevbabvgdeziyklmnoprstufhcye")
SPELT = {"ж": "zh", "ч": "ch", "ш": "sh", "щ": "sch", "ю": "yu", "я": "ya"}


def cyrillic_slug(name: Column) -> Column:
    for letter, spelt in SPELT.items():
        name = F.replace(name, F.lit(letter), F.lit(spelt))
    s = F.trim(F.regexp_replace(F.lower(F.translate(name, *LETTERS)), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(s == "", F.lit("region")).otherwise(s)


def mended(s: Column) -> Column:
    """Text whose UTF-8 was read as Latin-1, as it should have been; any other text as it is."""
    narrow = F.when(~s.rlike(r"[^\x{00}-\x{FF}]"), s)
    return F.coalesce(F.try_validate_utf8(F.encode(narrow, "ISO-8859-1").cast("string")), s)


def province_noun(n: Column) -> Column:
    return F.when(n == 1, "провинция").when(n.between(2, 4), "провинции").otherwise("провинций")


def tile_key(key: Column) -> list[Column]:
    """layer, z, x and y of a key layer|z/x/y."""
    rest = F.split(F.substring_index(key, "|", -1), "/")
    return [F.substring_index(key, "|", 1).cast("int"), *[rest[k].cast("int") for k in range(3)]]


def _without_accents(name: Column) -> Column:
    """Compatibility decomposition without the combining marks; Spark has no built-in normal forms."""

    def plain(names: pd.Series) -> pd.Series:
        return names.map(lambda s: "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)), na_action="ignore")

    return F.pandas_udf(plain, StringType())(name)


def nfkd_slug(name: Column) -> Column:
    """A slug of the base letters of any accented ones; names without marks beyond ASCII stay in the JVM."""
    return slug(F.when(name.rlike(r"[^\x{00}-\x{7F}]"), _without_accents(name)).otherwise(name))


def word_slug(name: Column) -> Column:
    """Each character that is no letter or digit of any script becomes an underscore, at the ends none."""
    s = F.trim(F.regexp_replace(F.lower(F.trim(name)), r"[^\p{L}\p{N}]", "_"), F.lit("_"))
    return F.when(s == "", F.lit("unnamed")).otherwise(s)


def safe_slug(name: Column) -> Column:
    """Latin letters, digits and Cyrillic ones with single underscores."""
    s = F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9а-яё]+", "_"), F.lit("_"))
    return F.when(s == "", F.lit("province")).otherwise(s)
