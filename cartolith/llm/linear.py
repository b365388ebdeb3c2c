"""Hashed sparse text features and the two linear models on them.

quality: word and word-shape n-grams, logistic regression by follow-the-regularised-leader (FTRL-proximal).
toxicity: word presence, cumulative-link ordinal regression with shared weights and ordered thresholds.
Features are made on the executors; a model is fitted on the driver from a bounded sample of labelled rows
(max_train rows, the smallest by a hash of the id) and sent back as one array of bounded size.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolith.llm.words import U64, Chunk, bare, chunks, mix
from cartolith.runtime import ship

BITS = 18
#: Bytes of text whose features are in memory at once, and the number that stands for no feature.
PIECE, NONE = 1 << 18, 0xFFFFFFFF
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[128:] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")


def shape_hashes(c: Chunk, seed: int) -> np.ndarray:
    """Hash of each word's shape: classes of characters with runs taken as one."""
    if not len(c.start):
        return np.zeros(0, U64)
    kind = _CLASS[c.data]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[c.start] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    kind = kind[keep]
    return Chunk(c.rows, kind, c.limits, place[c.start], place[c.end], c.first).hashes(seed)


def _pairs(h: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """Each word with the one before it in its row; a row's first word stands with a mark."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    starts = first[:-1][first[:-1] < len(h)]
    before[starts] = U64(seed)
    return mix(before * U64(0xC2B2AE3D27D4EB4F) + h + U64(seed))


def quality_features(c: Chunk) -> np.ndarray:
    """Feature numbers, one row for each word: word, word pair, shape, shape pair."""
    word, shape = c.hashes(11, lower=True), shape_hashes(c, 12)
    both = [word, _pairs(word, c.first, 13), shape, _pairs(shape, c.first, 14)]
    return (np.stack(both, 1) >> U64(64 - BITS)).astype(np.uint32)


def _labelled(labels: DataFrame, id_col: str, label_col: str, usable: Column) -> DataFrame:
    """(id, y) of the usable rows, one for each id; conflicting labels count as the smaller."""
    y = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y is not null").where(usable)
    return y.groupBy("id").agg(F.min("y").alias("y"))


def _texts(docs: DataFrame, y: DataFrame, id_col: str, text_col: str, max_train: int) -> DataFrame:
    """(id, y, text) of the max_train rows of y that are smallest by a hash of the id; that many are broadcast.

    An id that stands on several rows of docs counts once, with the smallest of its texts.
    """
    y = y.orderBy(F.xxhash64("id"), "id").limit(max_train)
    both = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(y), "id")
    return both.groupBy("id", "y").agg(F.min("text").alias("text"))


def _sparse(batches: Iterator[pa.RecordBatch], of: Callable[[Chunk], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, ys, xs, ns = b.column("id"), b.column("y"), [], []
        for c in chunks(b.column("text"), PIECE):
            f = of(c)
            for k in range(len(c.limits) - 1):
                own = f[c.first[k] : c.first[k + 1]]
                idx, n = np.unique(own[own != NONE], return_counts=True)
                xs.append(idx.astype("<u4").tobytes())
                ns.append(n.astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([ids, ys, pa.array(xs, pa.binary()), pa.array(ns, pa.binary())], ["id", "y", "x", "n"])


def ftrl(rows: list, dims: int, epochs: int = 4, alpha: float = 0.6, beta: float = 0.5, l1: float = 0.02, l2: float = 0.02, scale: float = 6.0) -> np.ndarray:
    """Weights of a logistic regression, the bias last. rows: (label, feature numbers, counts), in a fixed order."""
    z, n = np.zeros(dims + 1), np.zeros(dims + 1)
    weight = lambda z, n: np.where(np.abs(z) <= l1, 0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    for _ in range(epochs):
        for y, names, counts in rows:
            # made anew each time: rows stay as small as they came
            i = np.append(names, np.array([dims], names.dtype))
            x = np.append(counts * (scale / max(counts.sum(), 1)), 1.0)
            zi, ni = z[i], n[i]
            w = weight(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - float(y)) * x
            z[i] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[i] = ni + g * g
    return weight(z, n).astype(np.float32)


SCALE = 6.0


def fit_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", usable: Column | None = None, max_train: int = 4000) -> np.ndarray:
    """Fit the quality model on at most max_train labelled rows for which usable holds; without any, all weights are 0."""
    ship(docs.sparkSession)
    usable = F.lit(True) if usable is None else usable
    rows = _texts(docs, _labelled(labels, id_col, label_col, usable), id_col, text_col, max_train)
    rows = rows.mapInArrow(lambda it: _sparse(it, quality_features), f"id {dict(rows.dtypes)['id']}, y int, x binary, n binary").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r["id"]).encode()), str(r["id"])))
    return ftrl([(r["y"], np.frombuffer(r["x"], "<u4"), np.frombuffer(r["n"], "<u4")) for r in rows], 1 << BITS, scale=SCALE)


def _quality_scores(column: pa.Array, w: np.ndarray) -> np.ndarray:
    out = []
    for c in chunks(column, PIECE):
        each = w[quality_features(c)].sum(1, dtype=np.float64)
        total = np.concatenate([[0.0], np.cumsum(each)])
        n = 4.0 * np.maximum(1, c.first[1:] - c.first[:-1])
        out.append((total[c.first[1:]] - total[c.first[:-1]]) * SCALE / n + w[-1])
    return 1 / (1 + np.exp(-np.clip(np.concatenate(out), -35, 35))) if out else np.zeros(0)


def score_quality(docs: DataFrame, weights: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score for every row: a sparse dot product of the whole text's features. Null and empty texts get the bias alone."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_quality_scores(b.column(1), sent.value), pa.float64())], [id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {dict(docs.dtypes)[id_col]}, score double")


def keep_quality(docs: DataFrame, weights: np.ndarray, threshold: float = 0.5, *, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose score is at least the threshold."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_quality_scores(b.column(text_col), sent.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)


# --- toxicity -------------------------------------------------------------------------------------------------------

PREFIXES = (5, 6, 7, 8)
PLACES = 22


def word_features(c: Chunk) -> np.ndarray:
    """Feature numbers of bare lower-case words, their pairs and their first bytes, one row for each word; or NONE."""
    out = np.empty((len(c.start), 2 + len(PREFIXES)), np.uint32)
    if not len(c.start):
        return out
    c = bare(c)
    of = lambda end, seed: Chunk(c.rows, c.data, c.limits, c.start, end, c.first).hashes(seed, lower=True)
    whole = of(c.end, 21)
    out[:, 0] = whole >> U64(64 - PLACES)
    out[:, 1] = _pairs(whole, c.first, 22) >> U64(64 - PLACES)
    for j, k in enumerate(PREFIXES):
        out[:, 2 + j] = of(np.minimum(c.start + k, c.end), 23) >> U64(64 - PLACES)
        out[c.end - c.start < k, 2 + j] = NONE
    return out


class Ordinal:
    """P(grade >= k) = sigmoid(w.x - t_k), t_1 < t_2 < ...; features: sorted numbers of the chosen ones, 32767 at most."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.features, self.weights, self.thresholds = features, weights, thresholds
        self._lookup = None

    def __getstate__(self):
        return self.__dict__ | {"_lookup": None}

    def lookup(self) -> np.ndarray:
        """For each feature number its place among the chosen from 1, or 0; 8 MB."""
        if self._lookup is None:
            self._lookup = np.zeros(1 << PLACES, np.int16)
            self._lookup[self.features] = np.arange(1, len(self.features) + 1)
        return self._lookup

    def at_least(self, column: pa.Array) -> np.ndarray:
        """Rows by grades 1, 2, ...: the probability of that grade or a higher one."""
        eta, lookup, base = [], self.lookup(), len(self.features) + 1
        for c in chunks(column, PIECE):
            f = word_features(c)
            place = np.where(f != NONE, lookup[np.minimum(f, len(lookup) - 1)], 0)
            word, kind = np.nonzero(place)
            row = np.searchsorted(c.first, word, side="right") - 1
            pair = np.unique(row * base + place[word, kind])
            eta.append(np.bincount(pair // base, self.weights[pair % base - 1] if len(pair) else None, len(c.limits) - 1))
        eta = np.concatenate(eta) if eta else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(eta[:, None] - self.thresholds[None, :], -35, 35)))


def fit_ordinal(grades: np.ndarray, rows: list[np.ndarray], dims: int, levels: int, steps: int = 400, rate: float = 0.2, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds by full-batch Adam on the cumulative-link likelihood; rows: chosen features present."""
    w, t = np.zeros(dims), np.linspace(1, 2, levels)
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    col = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
    m = v = np.zeros(dims + levels)
    for step in range(1, steps + 1):
        eta = np.bincount(row, w[col], len(rows))
        upper = 1 / (1 + np.exp(-np.clip(eta[:, None] - t[None, :], -35, 35)))  # P(grade >= k)
        full = np.concatenate([np.ones((len(rows), 1)), upper, np.zeros((len(rows), 1))], 1)
        at = np.arange(len(rows))
        p = np.maximum(full[at, grades] - full[at, grades + 1], 1e-9)
        d = full * (1 - full)
        low, high = d[at, grades] / p, d[at, grades + 1] / p
        g_eta = -(low - high) / len(rows)
        g_t = np.array([((grades == k) * low - (grades == k - 1) * high).sum() for k in range(1, levels + 1)]) / len(rows)
        g = np.concatenate([np.bincount(col, g_eta[row], dims) + l2 * w, g_t])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w = w - move[:dims]
        t = np.maximum.accumulate(t - move[dims:] + 1e-6 * np.arange(levels))
    return w, t


def _counts(xs: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """In how many of the chosen rows each feature stands."""
    out = np.zeros(1 << PLACES, np.int32)
    for j in np.flatnonzero(chosen):
        out[xs[j]] += 1
    return out


def telling_features(xs: list[np.ndarray], toxic: np.ndarray, chosen: np.ndarray, least: float = 20.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features whose log-likelihood ratio between the chosen rows' classes is over least, the ratios, and whether they are 3 times as common in toxic rows."""
    a, b = _counts(xs, chosen & toxic), _counts(xs, chosen & ~toxic)
    na, nb = max(1, (chosen & toxic).sum()), max(1, (chosen & ~toxic).sum())
    part = lambda k, n, p: k * np.log(np.maximum(p, 1e-12)) + (n - k) * np.log(np.maximum(1 - p, 1e-12))
    names, ratios, sides = [], [], []
    for lo in range(0, len(a), PIECE):  # a piece at a time: the tables in double precision stay small
        i = lo + np.flatnonzero(a[lo : lo + PIECE] + b[lo : lo + PIECE])
        x, y = a[i].astype(float), b[i].astype(float)
        both = (x + y) / (na + nb)
        ratio = 2 * (part(x, na, x / na) + part(y, nb, y / nb) - part(x, na, both) - part(y, nb, both))
        tell = ratio > least
        names.append(i[tell])
        ratios.append(ratio[tell])
        sides.append((x / na > 3 * (y / nb))[tell])
    return np.concatenate(names), np.concatenate(ratios), np.concatenate(sides)


def proxy_grades(xs: list[np.ndarray], ns: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 for rows that are only known to be toxic or not, by cross-fitting.

    The rows are halved. Markers are chosen on one half, and the other half's toxic rows are graded by how often those
    markers occur: at or over the median of that half is 2, below it 1. So no row's grade hangs on features that were
    chosen by its own label, and the grade counts occurrences, where the model sees only presence.
    """
    grades, half = toxic.astype(np.int64), np.arange(len(xs)) % 2
    for k in (0, 1):
        names, _, toxic_side = telling_features(xs, toxic, half != k)
        marker = np.zeros(1 << PLACES, bool)
        marker[names[toxic_side]] = True
        own = np.flatnonzero((half == k) & toxic)
        if len(own) and marker.any():
            hits = np.array([ns[j][marker[xs[j]]].sum() for j in own])
            grades[own] += hits >= max(1, np.median(hits))
    return grades


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", usable: Column | None = None, max_train: int = 6000, max_features: int = 2048) -> Ordinal:
    """Fit severity grades from at most max_train labelled rows for which usable holds, half of them toxic.

    A label column with grades 0 to K is taken as it is. Labels of 0 and 1 say toxic or not and nothing of how severe:
    then grades 0, 1, 2 come from proxy_grades, which is a stand-in, not a judgement of people.
    Features are the max_features words, pairs and prefixes with the highest log-likelihood ratio between the classes.
    The thresholds are shifted by the difference between the shares of toxic rows in the sample and in the labels.
    """
    ship(docs.sparkSession)
    y = _labelled(labels, id_col, label_col, F.lit(True) if usable is None else usable).select("id", F.greatest("y", F.lit(0)).alias("y"))
    counted = dict(y.groupBy("y").count().collect())
    share = {0: counted.get(0, 0), 1: sum(n for k, n in counted.items() if k)}
    if not share[0] or not share[1]:
        return Ordinal(np.zeros(0, np.int64), np.zeros(0), np.array([0.0, 1.0]) + (-3 if share[1] else 3))
    rows = []
    for k in (0, 1):
        some = _texts(docs, y.where((F.col("y") > 0) == F.lit(k > 0)), id_col, text_col, max_train // 2)
        rows += some.mapInArrow(lambda it: _sparse(it, word_features), f"id {dict(some.dtypes)['id']}, y int, x binary, n binary").collect()
    rows.sort(key=lambda r: (r["y"], zlib.crc32(str(r["id"]).encode()), str(r["id"])))
    toxic = np.array([r["y"] > 0 for r in rows], bool)
    xs, ns = [np.frombuffer(r["x"], "<u4") for r in rows], [np.frombuffer(r["n"], "<u4") for r in rows]
    names, ratio, _ = telling_features(xs, toxic, np.ones(len(rows), bool))
    features = np.sort(names[np.argsort(-ratio, kind="stable")[:max_features]])
    grades = np.array([r["y"] for r in rows], np.int64) if max(counted) > 1 else proxy_grades(xs, ns, toxic)
    place = np.full(1 << PLACES, -1, np.int16)
    place[features] = np.arange(len(features))
    present = [p[p >= 0] for p in (place[x] for x in xs)]
    w, t = fit_ordinal(grades, present, len(features), max(2, max(counted)))
    return Ordinal(features, w, t - np.log(share[1] / share[0]) + np.log(max(1, toxic.sum()) / max(1, (~toxic).sum())))


def score_toxicity(docs: DataFrame, model: Ordinal, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """id, p_toxic, p_severe (grade 2 or more), severity (expected grade), toxic for every row.

    Null and empty texts have no features; rows that share an id are scored each by its own text.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            p = sent.value.at_least(b.column(1))
            cols = [b.column(0), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(p.sum(1)), pa.array(p[:, 0] >= threshold)]
            yield pa.RecordBatch.from_arrays(cols, [id_col, "p_toxic", "p_severe", "severity", "toxic"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {dict(docs.dtypes)[id_col]}, p_toxic double, p_severe double, severity double, toxic boolean")
