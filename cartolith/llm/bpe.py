"""Byte-level BPE over a tokenizer file: encoding by forced boundaries, decoding by concatenating byte strings.

A pair of bytes that no vocabulary entry contains cannot be merged over, so a cut between such bytes is certain and the
fragments on its two sides can be encoded alone. All such pairs are taken from the vocabulary into one table. Texts are
cut at each of them, except where the cut could change how the pre-tokenizer's pattern reads a fragment: inside a
character, between white space and what follows it, and around an apostrophe (see _readable). Fragments repeat, so they
are kept with their ids in a bounded table. A fragment that is not there is split by the pre-tokenizer, and its parts are
cut again at every such pair, inside characters too, before the merges run over each piece.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from cartolith.runtime import ship

#: The byte-level pre-tokenizer's white space, and more characters that some versions of Unicode count to it.
_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace()] + ["\u180e", "\u200b", "\ufeff"]
#: Bytes from which a fragment or piece counts as long.
LONG = 64
_SURE = b"\t\n\v\f\r "


def byte_of() -> dict[str, int]:
    """The bytes that stand behind the letters of byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _readable() -> np.ndarray:
    """Pairs of bytes between which a text can be cut without changing how the pattern reads either side.

    Never inside a character. Not after white space, which the pattern takes along with what follows, unless more white
    space does. Not after an apostrophe, and not before one but behind a letter or digit: contractions begin there.
    """
    out = np.ones((256, 256), bool)
    out[:, 0x80:0xC0] = False
    for w in (c.encode() for c in _WHITE):
        if len(w) == 1:
            out[w[0]] = False
    for a in _SURE:
        out[a, list(_SURE)] = True
    out[ord("'")] = False
    plain = np.zeros(256, bool)
    plain[[*b"0123456789", *range(65, 91), *range(97, 123)]] = True
    out[~plain, ord("'")] = False
    return out.reshape(-1)


class Bpe:
    """One tokenizer file, read. Ids of merged entries must follow the order of the merges, else ValueError."""

    PIECES = 400_000

    def __init__(self, file: bytes):
        told = json.loads(file)
        letters, vocab = byte_of(), told["model"]["vocab"]
        pre = told["pre_tokenizer"]
        if told["model"]["type"] != "BPE" or told["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True):
            raise ValueError("not a plain byte-level BPE file")
        special = {x["content"]: x["id"] for x in told["added_tokens"]}
        ranks = {bytes(letters[ch] for ch in t): i for t, i in vocab.items() if t not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in told["model"]["merges"]]
        order = [vocab["".join(m)] for m in merges]
        if order != sorted(order) or len(set(order)) != len(order) or len(ranks) != len(merges) + 256:
            raise ValueError("the vocabulary is not in the order of its merges")
        self.special, self.core = special, tiktoken.Encoding("file", pat_str=r"\s+|\S+", mergeable_ranks=ranks, special_tokens={})
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        #: By a pair of bytes as one number: no entry holds it; and it is also a cut that leaves the pattern's reading alone.
        self.never = np.ones(1 << 16, bool)
        for t in ranks:
            for k in range(len(t) - 1):
                self.never[t[k] << 8 | t[k + 1]] = False
        self.cut = self.never & _readable()
        #: Pairs that may end a white space character of several bytes, after which no cut is made.
        self.white_end = np.zeros(1 << 16, bool)
        self.white_end[[w[-2] << 8 | w[-1] for w in (c.encode() for c in _WHITE) if len(w) > 1]] = True
        self.model = Tokenizer.from_str(file.decode()).model
        self.split = ByteLevel(add_prefix_space=False, use_regex=True)
        entries = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        size = max(entries) + 1
        self.length = np.zeros(size, np.int64)
        for i, t in entries.items():
            self.length[i] = len(t)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])
        self.pool = np.frombuffer(b"".join(entries.get(i, b"") for i in range(size)), np.uint8)
        self.letters, self.known = letters, {}

    def _fragments(self, data: bytes) -> list[bytes]:
        """data cut at all certain places that the pattern allows; 0xFF stands in no UTF-8 and marks them."""
        if len(data) < 2:
            return [data]
        b = np.frombuffer(data, np.uint8)
        pair = b[:-1].astype(np.uint16) << 8 | b[1:]
        cut = self.cut[pair]
        cut[1:] &= ~self.white_end[pair[:-1]]
        return np.insert(b, np.flatnonzero(cut) + 1, 0xFF).tobytes().split(b"\xff")

    def _fragment(self, fragment: bytes) -> bytes:
        """Ids of one fragment, little-endian, kept for next time."""
        if len(self.known) >= self.PIECES:
            self.known.clear()
        text, ids = fragment.decode(), []
        letters = text.removeprefix(" ")
        if len(letters) < LONG and letters.isalpha() and max(letters) < "\u0250":
            ids = self.core._core_bpe.encode_single_piece(fragment)  # the pattern takes all of it
        else:
            for part, _ in self.split.pre_tokenize_str(text):
                ids += self._piece(part)
        out = np.array(ids, "<u4").tobytes()
        if len(fragment) < LONG:
            self.known[fragment] = out
        return out

    def _piece(self, part: str) -> list[int]:
        """Ids of one part of the pre-tokenizer, in its letters; a long one is cut at every certain place.

        What has no such place, like a long run of one character, goes to the library's merges, whose time does not
        grow with the square of the length.
        """
        piece = bytes(map(self.letters.__getitem__, part))
        if len(piece) < LONG:
            return self.core._core_bpe.encode_single_piece(piece)
        b = np.frombuffer(piece, np.uint8)
        ids, begin = [], 0
        for end in [*(np.flatnonzero(self.never[b[:-1].astype(np.uint16) << 8 | b[1:]]) + 1).tolist(), len(piece)]:
            ids += self.core._core_bpe.encode_single_piece(piece[begin:end]) if end - begin < LONG else [x.id for x in self.model.tokenize(part[begin:end])]
            begin = end
        return ids

    def _plain(self, text: str) -> bytes:
        pieces = self._fragments(text.encode())
        out = list(map(self.known.get, pieces))
        if None in out:
            out = [self._fragment(p) if x is None else x for x, p in zip(out, pieces, strict=True)]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.split_special or not any(s in text for s in self.special):
            return self._plain(text) if text else b""
        return b"".join(np.array([self.special[x]], "<u4").tobytes() if x in self.special else self._plain(x) for x in self.split_special.split(text) if x)

    def decode(self, ids: bytes) -> bytes:
        """The bytes behind ids; pieces of a million ids at a time."""
        every, out = np.frombuffer(ids, "<u4"), []
        for k in range(0, len(every), 1 << 17):
            i = every[k : k + (1 << 17)]
            n = self.length[i]
            ends = np.cumsum(n)
            out.append(self.pool[np.repeat(self.offset[i] - (ends - n), n) + np.arange(ends[-1])].tobytes())
        return b"".join(out)

    def decode_text(self, ids: bytes) -> str:
        return self.decode(ids).decode("utf-8", "replace")


_read: dict[bytes, Bpe] = {}


def load(file: bytes) -> Bpe:
    """The tokenizer of a file's content, once for each worker."""
    key = hashlib.sha256(file).digest()
    if key not in _read:
        _read.clear()
        _read[key] = Bpe(file)
    return _read[key]


def encode(docs: DataFrame, tokenizer_file: str, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with a binary column of ids (little-endian unsigned 32-bit); a column of that name is replaced.

    Null and empty texts have no ids; every row counts, also those that share an id. The file is read on the driver and must be under 64 MB; workers get its content.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(_content(tokenizer_file))
    docs = docs.drop(ids_col)

    def run(batches):
        bpe = load(sent.value)
        for b in batches:
            ids = pa.array([bpe.encode(t or "") for t in b.column(text_col).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, ids], [*b.schema.names, ids_col])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(ids_col, BinaryType())]))


def decode(tokens: DataFrame, tokenizer_file: str, *, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """tokens with a string column of the text behind the ids; a column of that name is replaced.

    Broken UTF-8 becomes replacement characters; null ids are an empty text.
    """
    ship(tokens.sparkSession)
    tokens = tokens.drop(text_col)
    sent = tokens.sparkSession.sparkContext.broadcast(_content(tokenizer_file))

    def run(batches):
        bpe = load(sent.value)
        for b in batches:
            out = pa.array([bpe.decode_text(x or b"") for x in b.column(ids_col).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, out], [*b.schema.names, text_col])

    return tokens.mapInArrow(run, StructType([*tokens.schema.fields, StructField(text_col, StringType())]))


def digests(docs: DataFrame, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass, of which only digests leave the worker."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(_content(tokenizer_file))

    def run(batches):
        bpe = load(sent.value)
        for b in batches:
            n, first, second = [], [], []
            for t in b.column(1):
                ids = bpe.encode(t.as_py() or "")
                n.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest())
                second.append(hashlib.sha256(bpe.decode_text(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(first), pa.array(second)], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {dict(docs.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _content(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(1 << 26)
    if len(data) == 1 << 26:
        raise ValueError(f"{path} is too large to broadcast")
    return data
