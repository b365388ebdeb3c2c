"""Awkward inputs, and the methods' parts against plain Python that shares no code with them."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartolith.llm import bpe, decontaminate, exact, licenses, linear, lines, minhash, pieces, substrings
from cartolith.llm.queries import registry
from cartolith.llm.queries.tokens import TOKENIZER
from cartolith.llm.words import chunks
from tests.oracle import rows_of_spark, rows_of_sql

FOLDER = "/root/testdata/sf0.001"
TWO = "doc_id long, text string"


def words(rng, n, letters="abcdeé"):
    return [("".join(rng.choice(letters) for _ in range(rng.randint(1, 5)))) for _ in range(n)]


def thue_morse(n):
    t = "a"
    while len(t) < n:
        t += t.translate(str.maketrans("ab", "ba"))
    return t, t.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, name):
    assert rows_of_spark(registry.QUERIES[name](spark, FOLDER)) == rows_of_sql(registry.SQL[name], FOLDER)


# --- words ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [8, 64, 256, 512, 1024, 8192])
def test_structured_words_do_not_collide(n):
    one, two = thue_morse(n)
    (c,) = chunks(pa.array([f"{one} {two} {one.upper()} {one}"]))
    for seed in (1, 11, 31, 33, 35, 43, 61):
        h, low = c.hashes(seed), c.hashes(seed, lower=True)
        assert len(set(h[:3].tolist())) == 3 and h[0] == h[3] and low[0] == low[2] and low[0] != low[1]


def test_structured_words_in_operators(spark):
    """Texts that differ in such words only are neither linked nor removed."""
    one, two = thue_morse(1024)
    rows = [(k, " ".join(f"{x}{j}" for j in range(30))) for k, x in enumerate((one, two))]
    frame = spark.createDataFrame(rows, TWO)
    assert {r.doc_id: r.n_removed for r in substrings.kept_digests(frame).collect()} == {0: 0, 1: 0}
    assert all(r.kept for r in minhash.near_groups(frame).collect())


# --- near duplicates ------------------------------------------------------------------------------------------------


def components_of_rows(rows, percent=85):
    """id -> smallest id, by comparing all pairs of rows; rows of one id are one document."""
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())))
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((root(i), root(j)))
                up[hi] = lo
    return {i: root(i) for i in up}


def test_near_repeated_ids(spark):
    rng = random.Random(3)
    base = [words(rng, 100) for _ in range(4)]
    near = [list(w) for w in base]
    for w in near:
        w[40] = "changed"
    t = [" ".join(w) for w in base]
    n = [" ".join(w) for w in near]
    for rows in ([(5, t[0]), (5, t[1]), (9, n[0]), (10, n[1]), (7, t[2])], [(5, t[0]), (3, t[0]), (5, t[1]), (10, n[1]), (3, t[0]), (8, ""), (8, n[0]), (12, t[3]), (12, None)]):
        got = minhash.near_groups(spark.createDataFrame(rows, TWO)).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: r.component_id for r in got} == components_of_rows(rows)
        assert sorted((r.doc_id, r.n_shingles) for r in got) == sorted((i, len(set(zip(*(x.split()[k:] for k in range(5)), strict=False)))) for i, x in ((i, x or "") for i, x in rows))
    mixed = minhash.near_groups(spark.createDataFrame([(None, t[0]), (4, t[0]), (4, n[0]), (None, t[0])], TWO)).collect()
    assert sorted((r.doc_id is None, r.component_id or 0, r.kept) for r in mixed) == [(False, 4, True), (False, 4, True), (True, 0, True), (True, 0, True)]


def test_near_joined_texts_agree_with_bitmap(spark, monkeypatch):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = rows_of_spark(minhash.near_groups(frame))
    monkeypatch.setattr(minhash, "MAP_BYTES", 0)
    assert rows_of_spark(minhash.near_groups(frame)) == want


def test_no_task_makes_many_keys(spark, monkeypatch):
    """Signatures of one file become keys in several tasks, each of about the bound, and no key is lost."""
    sig = np.random.default_rng(5).integers(0, 1 << 16, (100, minhash.SYMBOLS)).astype("<u2")
    reps = spark.createDataFrame([(k, s.tobytes()) for k, s in enumerate(sig)], "id long, sig binary").coalesce(1)
    monkeypatch.setattr(minhash, "TASK_KEYS", 10 * minhash.SYMBOLS)
    rows = minhash.keys_of(reps, 15).withColumn("task", F.spark_partition_id()).collect()
    assert max(Counter(r.task for r in rows).values()) <= 15 * minhash.SYMBOLS
    want = minhash.row_keys(sig, 15).view(np.int64)
    assert sorted((r.id, r.key) for r in rows) == sorted((k, int(x)) for k, row in enumerate(want) for x in row)


# --- BPE ------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def machine():
    return bpe.Bpe(open(TOKENIZER, "rb").read())


def ids_of(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("c", list(" \n\t\r\v"))
def test_bpe_long_white_space(machine, library, c):
    text = "ab" + c * 1_000_000 + "cd"
    assert machine.encode(text) == ids_of(library, text) and machine.decode_text(machine.encode(text)) == text


def test_bpe_every_low_character(machine, library):
    for code in range(0x3100):
        c = chr(code)
        for text in (f"a{c}b", f"1{c}1 {c} {c}{c}'s{c}'{c}s", f" {c}{c} a\n{c}b{c}\n"):
            assert machine.encode(text) == ids_of(library, text), hex(code)


def test_bpe_cuts_everywhere(machine, library):
    """Text without spaces is cut too, and no cut is at a pair that an entry holds."""
    rng = random.Random(6)
    for text in ("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(5000)), ";".join(f"var a{k}=f(b[{k}],'x')" for k in range(500)), "a\tb\tc\n" * 500):
        fragments = machine._fragments(text.encode())
        assert b"".join(fragments) == text.encode() and len(fragments) > len(text) / 5
        assert all(machine.never[a[-1] << 8 | b[0]] for a, b in zip(fragments, fragments[1:], strict=False))
        assert machine.encode(text) == ids_of(library, text)


def test_bpe_replaces_its_columns(spark):
    frame = spark.createDataFrame([(1, "some text", "old", 3)], "doc_id long, text string, ids string, decoded int")
    row = bpe.decode(bpe.encode(frame, TOKENIZER), TOKENIZER).first()
    assert row.decoded == "some text" and sorted(row.asDict()) == ["decoded", "doc_id", "ids", "text"]


# --- licences -------------------------------------------------------------------------------------------------------


def scan_plainly(text, rules):
    """n_words, base places, detections and score by Python's own regexes, without gates."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    line = " ".join(w)
    base = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
    found = []
    for r in rules:
        for m in re.finditer(rf"(?<![^ ])(?:{r.pattern})(?![^ ])", line):
            first = line[: m.start()].count(" ")
            found.append((r.priority, -(m[0].count(" ") + 1), first, first + m[0].count(" "), r.label))
    stay = []
    for d in sorted(set(found)):
        if not any(d[2] <= s[3] and s[2] <= d[3] for s in stay):
            stay.append(d)
    score = max([licenses.SURE[d[0]] for d in stay] + [licenses.BASE_SCORE if base else 0.0])
    return len(w), sorted(base), sorted((d[2], d[3], d[0], d[4]) for d in stay), score


def check_licenses(spark, texts, rules):
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), TWO), signature_rules=rules).collect()}
    for k, t in enumerate(texts):
        n, base, stay, score = scan_plainly(t, rules)
        r, places = got[k], [p for p, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), min(places, default=None), max(places, default=None)), t
        assert r.base_labels == ",".join(sorted({x for _, x in base})) and r.labels == ",".join(sorted({x for _, x in base} | {d[3] for d in stay})), t
        assert [tuple(d) for d in r.detections] == stay and r.score == score, t


def test_licences_against_plain_search(spark):
    rng = random.Random(7)
    rules = licenses.rules()
    assert len(rules) > 400 and len({r.pattern for r in rules}) == len(rules)
    bits = ["Licensed under the", "MIT", "License", "license", "Apache License, Version 2.0", "GNU General Public License v3", "bsd 3 clause", "the", "of", "public domain", "SPDX-License-Identifier: MIT", "all rights reserved", "Copyright (c) 2020", "cc by sa 4 0", "Mozilla Public License", "see the LICENSE file", "word", "é", "permit", "general public license", "is", "version 2 only", "Permission is hereby granted, free of charge, to any person obtaining a copy"]
    texts = [None, "", " ", "mit license " * 40, "license mit " * 40] + [" ".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(150)]
    check_licenses(spark, texts, rules)


def sample_of(pattern, rng):
    """A text that a pattern matches, its choices drawn by rng."""
    from re import _constants as C
    from re import _parser

    def text(tree):
        out = ""
        for op, arg in tree:
            if op is C.LITERAL:
                out += chr(arg)
            elif op is C.NOT_LITERAL:
                out += "q"
            elif op is C.IN:
                kind, what = rng.choice([x for x in arg if x[0] is not C.NEGATE])
                out += "q" if arg[0][0] is C.NEGATE else chr(what if kind is C.LITERAL else rng.randint(*what))
            elif op is C.BRANCH:
                out += text(rng.choice(arg[1]))
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
                out += "".join(text(arg[2]) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 2))))
            elif op is C.SUBPATTERN:
                out += text(arg[-1])
            else:
                assert op is C.ASSERT_NOT, op
        return out

    return text(_parser.parse(pattern))


def test_every_licence_rule_passes_its_gate_and_keyword(spark):
    """Texts that hold nothing but a match of one rule, its choices drawn at random, give what plain search gives."""
    rng = random.Random(10)
    texts = [sample_of(r.pattern, rng) for r in licenses.rules() for _ in range(3)]
    check_licenses(spark, texts, licenses.rules())


def test_licences_suppression(spark):
    """What is itself suppressed suppresses nothing; chains settle from the strongest on."""
    R = licenses.Rule
    check_licenses(spark, ["aa bb cc dd ee"], [R("aa", "wide", 5, "aa bb cc dd"), R("bb", "inner", 1, "bb"), R("dd", "strong", 2, "dd ee")])
    rng = random.Random(8)
    rules = [R(k, f"{k}{p}{n}", p, " ".join([k, *["[a-e]{2}"] * n])) for k in ("aa", "bb", "cc") for p in (1, 2, 3) for n in (0, 1, 3)]
    check_licenses(spark, [" ".join(rng.choice(["aa", "bb", "cc", "dd"]) for _ in range(n)) for n in (1, 5, 30, 60) for _ in range(6)], rules)


def test_licences_long_chain(spark):
    (r,) = licenses.scan_licenses(spark.createDataFrame([(1, "license mit " * 20_000)], TWO)).collect()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, len(r.detections)) == (40_000, 19_999, 1, 39_997, 20_000)


# --- lines ----------------------------------------------------------------------------------------------------------


def chunks_plainly(text):
    """The stated rule, line by line."""
    parts, before, marks = text.split("\n"), 0, []
    for k, line in enumerate(parts):
        h = int(hashlib.md5(line.encode()).hexdigest()[:7], 16)
        marks.append(k > 0 and ((h * 1_000_003 + before) % ((1 << 31) - 1) % 3 == 0 or line == parts[k - 1]))
        before = h
    out, own, last_was_end = [], [], False
    for line, mark in zip(parts, marks, strict=True):
        own.append(line)
        end = mark and not last_was_end
        last_was_end = end
        if end:
            out.append(own)
            own = []
    return out + [own] if own else out


def dedup_plainly(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        kept, n = [], 0
        for c in chunks_plainly(t or ""):
            body = "\n".join(c)
            n += len(c)
            if len(c) >= 2 and re.search(r"[^\x20\x09-\x0D]", body):
                if body in seen:
                    continue
                seen.add(body)
            kept.append(c)
        out[i] = (n, n - sum(map(len, kept)), "\n".join("\n".join(c) for c in kept))
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_lines_plainly(spark, weak):
    """With a digest of three values, nearly all chunks share one and only their bytes tell them apart."""
    rng = random.Random(2)
    passage = "\n".join(" ".join(words(rng, 6)) for _ in range(30))
    run = "\n".join(["same line here"] * 21)
    rows = [(k, "\n".join([" ".join(words(rng, 5))] * k) + "\n" + passage + "\n" + " ".join(words(rng, 5))) for k in range(8)]
    rows += [(20, None), (21, ""), (22, "a\nb"), (23, "\n" * 40), (24, "\n" * 40), (25, "\t\n" * 30), (26, "\t\n" * 30), (27, run), (28, run + "\n" + passage), (29, "\r\n" * 9), (30, passage), (31, passage)]
    named = {"digest": lambda c: lines.F.pmod(lines.F.xxhash64(c), lines.F.lit(3))} if weak else {}
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in lines.dedup_lines(spark.createDataFrame(rows, TWO).repartition(3), **named).collect()}
    assert got == dedup_plainly(rows)


def test_lines_repeated_ids(spark):
    """One id with two texts: neither text's removals fall on the other."""
    rng = random.Random(4)
    p, q = ("\n".join(" ".join(words(rng, 6)) for _ in range(12)) for _ in range(2))
    rows = [(1, p), (2, p), (2, q), (2, p), (None, p)]
    got = sorted((r.doc_id or 0, r.kept_text, r.n_removed) for r in lines.dedup_lines(spark.createDataFrame(rows, TWO)).collect())
    assert len(got) == 5 and (2, q, 0) in got and (1, p, 0) in got and (0, p, 0) in got
    gone = [x for x in got if x[0] == 2 and x[1] != q]
    assert len(gone) == 2 and gone[0] == gone[1] and gone[0][2] >= 10


# --- decontamination ------------------------------------------------------------------------------------------------


def leaks_plainly(rows, items, rate):
    """(row id, item id) where some window of the row is within the item's edits, by comparing all windows."""
    bare = lambda t: [re.sub(r"^[^0-9a-zA-Z\x80-\U0010FFFF]+(?=.*[0-9a-zA-Z\x80-\U0010FFFF])|[^0-9a-zA-Z\x80-\U0010FFFF]+$", "", x) or x for x in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
    out = set()
    for i, t in rows:
        w = bare(t)
        for k, x in items:
            v = bare(x)
            most = int(len(v) * rate) if len(v) >= 6 else 0
            # a window within the edits has all but that many of the item's words
            at = np.concatenate([[0], np.cumsum(np.isin(w, v))]) if v and w else np.zeros(len(w) + 1)
            some = at[np.minimum(np.arange(len(w)) + len(v) + most, len(w))] - at[: len(w)]
            for p in np.flatnonzero(some >= len(v) - most).tolist() if v else ():
                d = list(range(len(v) + 1))  # edits between the item's start and the window so far
                ends = []
                for n, word in enumerate(w[p : p + len(v) + most], 1):
                    new = [n]
                    for j, y in enumerate(v, 1):
                        new.append(min(d[j - 1] + (word != y), d[j] + 1, new[-1] + 1))
                    d = new
                    ends.append(d[-1])
                if min(ends, default=99) <= most:
                    out.add((i, k))
                    break
    return out


@pytest.mark.parametrize("kind", ["int", "string", "bigint"])
def test_leaks_against_all_windows(spark, kind):
    rng = random.Random(14)
    items = [(k, words(rng, rng.randint(3, 30))) for k in range(12)]
    rows = []
    for k, v in items:
        for edits in range(0, 5):
            w = list(v)
            for _ in range(edits):
                j = rng.randrange(len(w))
                w[j : j + rng.choice((0, 1))] = rng.choice(([], ["new"]))
                w = w or ["left"]
            rows.append((len(rows), " ".join(words(rng, 12) + w + words(rng, 12))))
    rows += [(900, None), (901, ""), (902, " ".join(items[0][1]))]
    items = [(k, " ".join(v)) for k, v in items]
    want = leaks_plainly(rows, items, decontaminate.RATE)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr(f"cast(item_id as {kind}) as item_id", "text")
    frame = spark.createDataFrame(rows, TWO).selectExpr(f"cast(doc_id as {kind}) as doc_id", "text")
    got = {(int(r.doc_id), int(r.item_id)) for r in decontaminate.find_leaks(frame, bench).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and len(want) > 25


def test_samples_select():
    """Windows that share a third of an item's words in place are seldom candidates; those within its edits are."""
    rng, draw = np.random.default_rng(1), random.Random(1)
    items = [(k, " ".join(words(draw, 30))) for k in range(20)]
    block = decontaminate.Items(items, decontaminate.RATE, decontaminate.REPEATS, decontaminate.SAMPLES)
    rate = {}
    for share in (0.3, 0.9):
        hit = tried = 0
        for steps, members, _, _ in block.classes:
            for m in members:
                s = block.items[m][1]
                x = np.where(rng.random((60, len(s))) < share, s, 10**6 + rng.integers(0, 10**6, (60, len(s))))
                pad = lambda a: np.concatenate([a, np.full((len(a), max(0, steps - len(s))), -1)], 1)[:, :steps]
                keys, own = (decontaminate.sample_keys(pad(a), block.repeats, block.size) for a in (x, s[None, :]))
                hit, tried = hit + (keys == own).any(1).sum(), tried + 60
        rate[share] = hit / tried
    assert rate[0.3] < 0.2 and rate[0.9] > 0.97, rate


# --- substrings -----------------------------------------------------------------------------------------------------


def test_substrings_ids(spark):
    rng = random.Random(5)
    t = [" ".join(words(rng, 40)) for _ in range(3)]
    rows = [("b", t[0]), ("a", t[0] + " " + t[1]), ("c", t[1])]
    got = {r.doc_id: r.n_removed for r in substrings.kept_digests(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"a": 0, "b": 40, "c": 40}
    for named in ({}, {"max_bitmap_bytes": 0}):
        twice = substrings.kept_digests(spark.createDataFrame([(1, t[0]), (1, t[1]), (1, t[0]), (2, t[1]), (2, t[2])], TWO), **named).collect()
        assert sorted((r.doc_id, r.n_removed) for r in twice) == [(1, 0), (1, 0), (1, 0), (2, 0), (2, 40)]


def test_exact_ids_of_text(spark):
    """The hot path and the ordinary one choose the same winners, for ids of any ordered type."""
    rows = [(f"id{k % 90:02}", " same" * (k % 4 == 0) + " same" if k % 3 else f"text {k % 40}") for k in range(400)] + [(None, "same  same  ")]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    got = sorted(map(str, exact.exact_groups(frame).collect()))
    assert got == sorted(map(str, exact.exact_groups(frame, heavy=1).collect()))
    best = {}
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (0, True, "")), (-len(t), i is None, i or ""))
    for r in exact.exact_groups(frame).collect():
        (key,) = [k for k in best if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256]
        assert (r.keep_id or "") == best[key][2]


# --- models ---------------------------------------------------------------------------------------------------------


def test_ftrl_plainly():
    """The vectorised learner against a loop over single weights."""
    rng = random.Random(6)
    dims, alpha, beta, l1, l2, scale = 12, 0.6, 0.5, 0.02, 0.02, 6.0
    rows = []
    for _ in range(60):
        x = sorted(rng.sample(range(dims), rng.randint(0, 5)))
        rows.append((int(sum(x) % 3 == 0), np.array(x, np.int64), np.array([rng.randint(1, 4) for _ in x], float)))
    z, n = [0.0] * (dims + 1), [0.0] * (dims + 1)
    weight = lambda i: 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)
    for _ in range(4):
        for y, xs, cs in rows:
            x = {int(i): scale * c / cs.sum() for i, c in zip(xs, cs, strict=True)} | {dims: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    assert np.allclose(linear.ftrl(rows, dims), [weight(i) for i in range(dims + 1)], atol=1e-5)


def test_quality_score_is_the_sparse_product():
    rng = np.random.default_rng(2)
    w = rng.normal(size=(1 << linear.BITS) + 1).astype(np.float32)
    texts = ["one two Two 3", "", "ä b!", " ".join(words(random.Random(1), 400))]
    got = linear._quality_scores(pa.array(texts), w)
    for t, s in zip(texts, got, strict=True):
        (c,) = chunks(pa.array([t]))
        f = linear.quality_features(c).reshape(-1)
        eta = float(w[-1]) + sum(float(w[i]) * linear.SCALE * n / len(f) for i, n in zip(*np.unique(f, return_counts=True), strict=True))
        assert math.isclose(s, 1 / (1 + math.exp(-max(-35, min(35, eta)))), rel_tol=1e-6)


def test_ordinal_recovers_grades():
    """Graded rows drawn from known weights and thresholds: both come back, and the gradient vanishes there."""
    rng = np.random.default_rng(3)
    dims, w, t = 6, np.array([2.0, 1.0, 0.0, -1.0, 0.5, -2.0]), np.array([0.0, 1.5, 3.0])
    rows = [np.flatnonzero(rng.random(dims) < 0.5) for _ in range(20_000)]
    eta = np.array([w[x].sum() for x in rows])
    grades = (rng.logistic(size=len(rows)) + eta)[:, None] >= t[None, :]
    got_w, got_t = linear.fit_ordinal(grades.sum(1), rows, dims, 3, l2=0.0)
    assert np.abs(got_w - w).max() < 0.15 and np.abs(got_t - t).max() < 0.15 and (np.diff(got_t) > 0).all()

    def loss(w, t):
        eta = np.array([w[x].sum() for x in rows])
        full = np.concatenate([np.ones((len(rows), 1)), 1 / (1 + np.exp(-(eta[:, None] - t))), np.zeros((len(rows), 1))], 1)
        k = grades.sum(1)
        return -np.log(full[np.arange(len(rows)), k] - full[np.arange(len(rows)), k + 1]).mean()

    for j in range(dims + 3):
        step = np.zeros(dims + 3)
        step[j] = 1e-4
        slope = (loss(got_w + step[:dims], got_t + step[dims:]) - loss(got_w - step[:dims], got_t - step[dims:])) / 2e-4
        assert abs(slope) < 2e-3


def test_toxicity_takes_given_grades(spark):
    """Labels with grades of their own are the severity; expected severity follows them on held-out rows."""
    rng = random.Random(9)
    rows = [(k, " ".join(["filler"] * 5 + words(rng, 10) + [["calm"], ["rude"], ["rude", "vile"]][k % 3] * 3)) for k in range(900)]
    frame = spark.createDataFrame(rows, TWO)
    labels = spark.createDataFrame([(k, k % 3) for k in range(600)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in linear.score_toxicity(frame, linear.fit_toxicity(frame, labels)).collect()}
    mean = [np.mean([out[k].severity for k in range(600, 900) if k % 3 == g]) for g in range(3)]
    assert mean[0] < 0.3 and 0.7 < mean[1] < 1.3 and mean[2] > 1.7


# --- all --------------------------------------------------------------------------------------------------------------


def test_long_texts_nulls_and_clashing_columns(spark):
    rng = random.Random(12)
    long = "\n".join(" ".join(words(rng, 12)) for _ in range(4000)) * 3 + "x" * 300_000
    rows = [(1, long, "k", 1, "i", 2), (1, long, "k", 1, "i", 2), (2, None, None, None, None, None), (None, "zulu yoke", "h", 2, "r", 3), (None, None, "", 0, "", 0), (7, "", "", 0, "", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string, n int, id string, pos int")
    weights = np.zeros((1 << linear.BITS) + 1, np.float32)
    model = linear.Ordinal(np.zeros(0, np.int64), np.zeros(0), np.array([0.0, 1.0]))
    bench = spark.createDataFrame([(1, "zulu yoke", "x"), (2, None, None)], "item_id int, text string, doc_id string")
    whole = {
        "near": minhash.near_groups(frame), "bpe": bpe.digests(frame, TOKENIZER), "toxic": linear.score_toxicity(frame, model), "licence": licenses.scan_licenses(frame), "exact": exact.exact_groups(frame),
        "lines": lines.dedup_lines(frame), "pieces": pieces.count_pieces(frame, TOKENIZER), "quality": linear.score_quality(frame, weights), "substring": substrings.kept_digests(frame),
    }
    for name, out in whole.items():
        assert len(out.collect()) == len(rows), name
    assert [tuple(r) for r in decontaminate.find_leaks(frame, bench).collect()] == [(None, 1, 0, 0, 2)]
    for name, out in {"near": minhash.drop_near(frame), "exact": exact.drop_exact(frame), "leaks": decontaminate.drop_leaks(frame, bench), "quality": linear.keep_quality(frame, weights)}.items():
        assert out.columns == frame.columns and out.count() >= 4, name
    empty = frame.limit(0)
    for out in (minhash.drop_near(empty), exact.drop_exact(empty), decontaminate.drop_leaks(empty, bench), linear.keep_quality(empty, weights)):
        assert out.columns == frame.columns and out.count() == 0


def test_pipeline_plainly(spark, library):
    """The last four stages from the classifier's verdicts, by plain Python and the tokenizers library."""
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = p.quality(spark, docs, FOLDER).collect()
    best = {}
    for r in good:
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[key] = min(best.get(key, (1, 0, "")), (-len(r.text or ""), r.doc_id, r.text or ""))
    left = [(i, t) for _, i, t in best.values()]
    near = components_of_rows(left, 80)
    left = [(i, t) for i, t in left if near[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    hit = {i for i, _ in leaks_plainly(left, items, decontaminate.RATE)}
    want = {i: hashlib.sha256(ids_of(library, t)).hexdigest() for i, t in left if i not in hit}
    assert {r.doc_id: r.ids_sha256 for r in p.run(spark, FOLDER).collect()} == want


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline as p

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert p.run(spark, str(tmp_path)).collect() == []
