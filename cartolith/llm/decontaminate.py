"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edit distance, all over words.

Texts become words between white space, without marks at either end and lower-cased (A-Z). For each item of w words
every window of w - k to w + k words of a document, k = max_edits(w), is compared by word edit distance; a window
matches within k edits. The CGK walk reads a word sequence and, at each of its steps (1.5 times the smallest size of the
item's class), copies the current word and moves on or not by a random bit of (step, word): sequences at a small edit
distance come out at a small Hamming distance. Each of REPEATS repetitions has its own walk and samples SAMPLES steps of
it; windows and items with equal samples are candidates, which banded edit distance then verifies. With 5 samples and 64
repetitions 1368 of 1368 passages with 1 to all allowed edits were found (replaced, inserted, dropped and mixed words);
of windows that share 30 % of an item's words in place 8 % are candidates, of those that share 10 % 1 %.

Before that, windows that cannot match are left out without loss: k edits touch at most 2k of an item's w - 1 word
pairs, so a window within k edits holds at least w - 1 - 2k pairs of neighbours that the item has.
Items go to the workers in blocks of bounded size; each block is one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cartolith.llm.words import U64, bare, chunks, constants, mix
from cartolith.runtime import ship

RATE, REPEATS, SAMPLES, LEAST_WORDS = 0.12, 64, 5, 6
BLOCK_BYTES = 1 << 23
TABLE = 22


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    """Word hashes of each text."""
    out = []
    for c in chunks(pa.array(texts, pa.string())):
        h = bare(c).hashes(61, lower=True)
        out += [h[a:b] for a, b in zip(c.first, c.first[1:], strict=False)]
    return out


def pair_places(h: np.ndarray) -> np.ndarray:
    """Place in a table of 2**TABLE of each word and the next one; the last word has none."""
    return (mix(h[:-1] * U64(0x9FB21C651E98DF25) + h[1:]) >> U64(64 - TABLE)).astype(np.int64)


def max_edits(width: int, rate: float = RATE) -> int:
    return int(width * rate)


def within(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance of two sequences if it is at most most; band of 2 * most + 1 diagonals."""
    if abs(len(a) - len(b)) > most:
        return None
    far = most + 1
    old = [min(j, far) for j in range(len(b) + 1)]
    for i in range(1, len(a) + 1):
        new = [far] * (len(b) + 1)
        new[0] = min(i, far)
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            new[j] = min(old[j - 1] + (a[i - 1] != b[j - 1]), old[j] + 1, new[j - 1] + 1, far)
        if min(new) >= far:
            return None
        old = new
    return old[-1] if old[-1] <= most else None


def closest_end(text: list, item: list, most: int) -> tuple[int, int] | None:
    """(edits, width) of the prefix of text that is closest to item, if within most edits.

    Of equally close prefixes the one nearest to the item's width counts, then the shorter one.
    """
    n, width, far = len(text), len(item), most + 1
    if n < width - most:
        return None
    old = [min(j, far) for j in range(n + 1)]
    for i in range(1, width + 1):
        new = [far] * (n + 1)
        if i <= most:
            new[0] = i
        low = new[0]
        for j in range(max(1, i - most), min(n, i + most) + 1):
            d = old[j - 1] + (item[i - 1] != text[j - 1])
            if old[j] < d:
                d = old[j] + 1
            if new[j - 1] < d:
                d = new[j - 1] + 1
            if d < far:
                new[j] = d
                low = min(low, d)
        if low >= far:
            return None
        old = new
    d, _, end = min((old[j], abs(j - width), j) for j in range(max(0, width - most), min(n, width + most) + 1))
    return (d, end) if d <= most else None


def sample_keys(seqs: np.ndarray, repeats: int, size: int) -> np.ndarray:
    """One key for each row and repetition: sampled steps of that repetition's CGK embedding.

    seqs has as many columns as the walk has steps, with a filler behind the end. Repetitions walk side by side.
    """
    rows, steps = seqs.shape
    flat = (seqs.astype(np.int64) + 2).view(U64)
    turn = constants(steps * repeats, 51).reshape(steps, repeats)
    weight = np.zeros((steps, repeats), U64)
    pick = (mix(np.arange(repeats * size, dtype=U64) + U64(7)) % U64(steps)).astype(np.int64).reshape(repeats, size)
    for j in range(size):
        weight[pick[:, j], np.arange(repeats)] += constants(repeats * size, 52)[j::size]
    at, every = np.zeros((rows, repeats), np.int64), np.arange(rows)[:, None]
    keys = np.zeros((rows, repeats), U64)
    for step in range(pick.max() + 1):
        word = flat[every, at]
        keys += word * weight[step]
        at += ((word * turn[step]) >> U64(63)).astype(np.int64)
    return mix(keys + np.arange(repeats, dtype=U64) * U64(0xE7037ED1A0B428DB))


class Items:
    """One block of benchmark items, ready for look-ups."""

    def __init__(self, items: list[tuple[int, str]], rate: float, repeats: int, size: int):
        self.rate, self.repeats, self.size = rate, repeats, size
        hashes = item_words([t for _, t in items])
        self.vocabulary = np.unique(np.concatenate([*hashes, np.zeros(0, U64)]))
        self.pairs = np.zeros(1 << TABLE, bool)
        groups: dict[int, list] = {}
        for (i, _), h in zip(items, hashes, strict=True):
            if len(h):
                self.pairs[pair_places(h)] = True
                groups.setdefault(len(h), []).append((i, np.searchsorted(self.vocabulary, h)))
        #: For each class of similar sizes: steps of the walk, the sizes, and by sorted key the item's place
        self.classes = []
        self.items = [(i, s) for width in sorted(groups) for i, s in groups[width]]
        by_class: dict[int, list[int]] = {}
        for k, (_, s) in enumerate(self.items):
            by_class.setdefault(int(np.log(len(s)) / np.log(1.2)), []).append(k)
        for own in by_class.values():
            sizes = sorted({len(self.items[k][1]) for k in own})
            steps = max(2, int(1.5 * sizes[0]))
            seqs = np.full((len(own), max(steps, sizes[-1])), -1, np.int64)
            for row, k in enumerate(own):
                seqs[row, : len(self.items[k][1])] = self.items[k][1]
            keys = sample_keys(seqs[:, :steps], repeats, size).reshape(-1)
            order = np.argsort(keys, kind="stable")
            self.classes.append((steps, frozenset(own), keys[order], np.repeat(np.array(own), repeats)[order]))
        at = [np.unique(pair_places(self.vocabulary[s])) if len(s) > 1 else np.zeros(0, np.int64) for _, s in self.items]
        places, names = np.concatenate([*at, np.zeros(0, np.int64)]), np.repeat(np.arange(len(at)), [len(x) for x in at])
        order = np.argsort(places, kind="stable")
        #: Items by the places of their pairs: those of places[k] are owners[limits[k]:limits[k + 1]]
        self.places, first = np.unique(places[order], return_index=True)
        self.owners, self.limits = names[order], np.append(first, len(places))
        self.needs = np.array([self.needed(len(s)) for _, s in self.items], np.int64)
        self.least = min((self.needed(len(s)) for _, s in self.items), default=0)

    def edits(self, width: int) -> int:
        return max_edits(width, self.rate) if width >= LEAST_WORDS else 0

    def needed(self, width: int) -> int:
        return max(0, width - 1 - 2 * self.edits(width))

    def rows(self, column: pa.Array) -> Iterator[tuple[int, dict[int, tuple[int, int, int]]]]:
        """(row, matches) of the rows of a column that match something."""
        for c in chunks(column):
            h = bare(c).hashes(61, lower=True)
            hit = np.zeros(len(h) + 1, np.int64)
            if len(h) > 1:
                hit[1:-1] = np.cumsum(self.pairs[pair_places(h)])
                hit[-1] = hit[-2]
            # pairs over a row's end may count here and not later: this only lets more rows through
            for k in np.flatnonzero(hit[c.first[1:]] - hit[c.first[:-1]] >= self.least):
                if found := self.matches(h[c.first[k] : c.first[k + 1]]):
                    yield c.rows.start + int(k), found

    def matches(self, h: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """item -> (edits, start, width) of the best window, the earliest of equal ones."""
        n, best = len(h), {}
        if not n or not self.items:
            return best
        # which items' pairs stand where
        own_places = pair_places(h)
        where = np.flatnonzero(self.pairs[own_places])
        k = np.searchsorted(self.places, own_places[where])
        many = self.limits[k + 1] - self.limits[k]
        ends = np.cumsum(many)
        owner = self.owners[np.repeat(self.limits[k] - (ends - many), many) + np.arange(many.sum())]
        where = np.repeat(where, many)
        likely = np.flatnonzero(np.bincount(owner, minlength=len(self.items)) >= self.needs)
        windows: dict[int, np.ndarray] = {}
        for item in likely.tolist():
            width = len(self.items[item][1])
            if n < width - self.edits(width):
                continue
            seen = np.zeros(n + 1, np.int64)
            seen[where[owner == item] + 1] = 1
            seen = np.cumsum(seen)
            start = np.arange(n - (width - self.edits(width)) + 1)
            windows[item] = start[seen[np.minimum(start + width + self.edits(width), n) - 1] - seen[start] >= self.needs[item]]
        windows = {item: start for item, start in windows.items() if len(start)}
        if not windows:
            return best
        place = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        base = len(self.vocabulary)
        # words outside the vocabulary get numbers of their own, equal only for equal words
        seq = np.where(self.vocabulary[place] == h, place, base + 1 + np.unique(h, return_inverse=True)[1])
        for steps, members, sorted_keys, own in self.classes:
            if not windows.keys() & members:
                continue
            may, valid = np.zeros(n, bool), {}
            for item in windows.keys() & members:
                valid[item] = np.zeros(n, bool)
                valid[item][windows[item]] = True
                may |= valid[item]
            start = np.flatnonzero(may)
            padded = np.concatenate([seq, np.full(steps, base)])
            found = set()
            for lo in range(0, len(start), 1024):
                at = start[lo : lo + 1024]
                keys = sample_keys(padded[at[:, None] + np.arange(steps)], self.repeats, self.size)
                left = np.searchsorted(sorted_keys, keys, side="left")
                right = np.searchsorted(sorted_keys, keys, side="right")
                for x, r in zip(*np.nonzero(right > left), strict=True):
                    found.update((item, int(at[x])) for item in own[left[x, r] : right[x, r]].tolist() if item in valid and valid[item][at[x]])
            by_item: dict[int, list[int]] = {}
            for item, at in sorted(found):
                by_item.setdefault(item, []).append(at)
            for item, starts in by_item.items():
                name, words = self.items[item]
                width = len(words)
                exact = next((p for p in starts if p + width <= n and np.array_equal(seq[p : p + width], words)), None)
                if exact is not None:
                    best[name] = (0, exact, width)
                    continue
                words, most = words.tolist(), self.edits(width)
                for p in starts if most else ():
                    end = closest_end(seq[p : p + width + most].tolist(), words, most)
                    if end is not None and (name not in best or (end[0], p) < best[name][:2]):
                        best[name] = (end[0], p, end[1])
                        most = end[0]
        return best


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Items in lists of bounded size; the driver holds one list at a time."""
    own, size = [], 0
    for r in benchmark.select(id_col, text_col).where(F.col(text_col).isNotNull()).orderBy(id_col).toLocalIterator():
        own.append((r[0], r[1]))
        size += len(r[1].encode()) + 64
        if size >= block_bytes:
            yield own
            own, size = [], 0
    if own:
        yield own


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = RATE, repeats: int = REPEATS, size: int = SAMPLES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, item_id, edits, first_word, n_words): for each row and item it holds, the closest window.

    Null and empty texts and items hold and match nothing. An item of fewer than LEAST_WORDS words must stand exactly.
    Windows may be longer or shorter than the item by its allowed edits. Of equally close windows the earliest counts;
    items with equal words match each. Rows that share an id, and rows without one, are looked at each by itself.
    Items go out in blocks of block_bytes, and each block is a pass over docs: meant for benchmarks that are small
    beside the corpus.
    """
    spark = docs.sparkSession
    ship(spark)
    kind, item_kind = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    schema = f"{id_col} {kind}, item_id {item_kind}, edits int, first_word int, n_words int"
    found = None
    for block in item_blocks(benchmark, item_col, item_text, block_bytes):
        sent = spark.sparkContext.broadcast(Items(block, rate, repeats, size))

        def run(batches, sent=sent):
            for b in batches:
                out = []
                for row, matches in sent.value.rows(b.column(1)):
                    out += [(b.column(0)[row].as_py(), item, *where) for item, where in sorted(matches.items())]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((b.schema.field(0).type, item_type, pa.int32(), pa.int32(), pa.int32()))], [id_col, "item_id", "edits", "first_word", "n_words"])

        one = docs.select(id_col, text_col).mapInArrow(run, schema)
        found = one if found is None else found.union(one)
    return found if found is not None else spark.createDataFrame([], schema)


def flag_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **named) -> DataFrame:
    """(id, item_ids, n_items, least_edits): one row for each document that holds an item."""
    found = find_leaks(docs, benchmark, id_col=id_col, **named)
    return found.groupBy(id_col).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.count_distinct("item_id").alias("n_items"), F.min("edits").alias("least_edits"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **named) -> DataFrame:
    """docs without the rows that hold an item; all columns. Rows without an id stay.

    Rows that share an id are one document here: where one of them goes, all do, whatever their texts.
    """
    lost = find_leaks(docs, benchmark, id_col=id_col, **named).select(id_col).where(F.col(id_col).isNotNull()).distinct()
    return docs.join(lost, id_col, "left_anti").select(docs.columns)
