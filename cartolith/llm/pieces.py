"""Counts of greedy longest-match word pieces by one linear pass of an automaton.

The vocabulary's entries form a trie over bytes. Each node v has a failure link: the node for what is left of v's
string after the longest entries that prefix it have been taken off, and the number taken off. A text then needs one
look-up a byte: the next node, and how many tokens are finished by going there. The links are resolved beforehand into
one table for (node, byte), so that no piece is built and no step goes back. A word is a run of bytes other than white
space with the word mark (by default a space) before it; all single bytes must be entries, so every word has pieces.
Words are stepped side by side: the first byte of all words, then the second, and so on.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartolith.llm.bpe import _content, byte_of
from cartolith.llm.words import chunks
from cartolith.runtime import ship


class Automaton:
    def __init__(self, entries: list[bytes], mark: bytes = b" "):
        single = {bytes([b]) for b in range(256)}
        vocab = set(entries) - {b""}
        if not single <= vocab:
            raise ValueError("every single byte must be an entry")
        child: list[dict[int, int]] = [{}]
        text, whole = [b""], [False]
        for t in sorted(vocab, key=lambda t: (len(t), t)):
            v = 0
            for k, c in enumerate(t):
                u = child[v].get(c)
                if u is None:
                    u = child[v][c] = len(child)
                    child.append({})
                    text.append(t[: k + 1])
                    whole.append(False)
                v = u
            whole[v] = True
        order = sorted(range(len(child)), key=lambda v: len(text[v]))
        # go[v, c]: the node after byte c at v; done[v, c]: tokens finished on the way
        go = np.zeros((len(child), 256), np.int32)
        done = np.zeros((len(child), 256), np.uint16)
        self.tail = np.zeros(len(child), np.int32)  # tokens in what a node still holds
        fail, taken = np.zeros(len(child), np.int32), np.zeros(len(child), np.int32)
        for c, u in child[0].items():
            go[0, c] = u
        for v in order[1:]:
            t = text[v]
            if whole[v]:
                fail[v], taken[v], self.tail[v] = 0, 1, 1
            else:
                k = next(k for k in range(len(t) - 1, 0, -1) if t[:k] in vocab)
                u, n = 0, 1
                for c in t[k:]:
                    n += int(done[u, c])
                    u = go[u, c]
                fail[v], taken[v] = u, n
                self.tail[v] = n + self.tail[u]
            go[v] = go[fail[v]]
            done[v] = done[fail[v]] + taken[v]
            for c, u in child[v].items():
                go[v, c], done[v, c] = u, 0
        self.go, self.done = go.reshape(-1), done.reshape(-1)
        v = n = 0
        for c in mark:
            n += int(self.done[v * 256 + c])
            v = int(self.go[v * 256 + c])
        self.begin = (v, n)

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each word."""
        order = np.argsort(start - end, kind="stable")  # longest first: those still running are a prefix
        at, length = start[order], (end - start)[order]
        node = np.full(len(at), self.begin[0], np.int64)
        count = np.full(len(at), self.begin[1], np.int64)
        left = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), side="right")
        for k, n in enumerate(left):
            i = node[:n] * 256 + data[at[:n] + k]
            count[:n] += self.done[i]
            node[:n] = self.go[i]
        count += self.tail[node]
        out = np.empty_like(count)
        out[order] = count
        return out


def entries_of(file: bytes) -> list[bytes]:
    """The entries of a byte-level tokenizer file, without added tokens."""
    told, letters = json.loads(file), byte_of()
    added = {x["content"] for x in told["added_tokens"]}
    return [bytes(letters[c] for c in t) for t in told["model"]["vocab"] if t not in added]


_built: dict[bytes, Automaton] = {}


def _automaton(file: bytes) -> Automaton:
    key = hashlib.sha256(file).digest()
    if key not in _built:
        _built.clear()
        _built[key] = Automaton(entries_of(file))
    return _built[key]


def count_pieces(docs: DataFrame, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_tokens, max_word_tokens for every row's whole text; null and empty texts have 0 of each."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(_content(tokenizer_file))

    def run(batches):
        machine = _automaton(sent.value)
        for b in batches:
            words, tokens, most = [], [], []
            for c in chunks(b.column(1)):
                n = machine.words(c.data, c.start, c.end)
                total = np.concatenate([[0], np.cumsum(n)])
                words.append(np.diff(c.first))
                tokens.append(np.diff(total[c.first]))
                top = np.zeros(len(c.first) - 1, np.int64)
                some = c.first[1:] > c.first[:-1]
                if some.any():
                    top[some] = np.maximum.reduceat(n, c.first[:-1][some])
                most.append(top)
            flat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), flat(words), flat(tokens), flat(most)], [id_col, "n_words", "n_tokens", "max_word_tokens"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {dict(docs.dtypes)[id_col]}, n_words long, n_tokens long, max_word_tokens long")
