"""A set of 64-bit hashes as one array of bits, for broadcasting where its size is bounded."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartolith.llm.words import U64

SPAN = 1 << 13  # bytes of one piece of the bitmap


class Bitmap:
    """Set of 64-bit hashes: bit number is the hash's top bits."""

    def __init__(self, shift: int, bits: np.ndarray):
        self.shift, self.bits = shift, bits

    def __call__(self, row: np.ndarray, h: np.ndarray) -> np.ndarray:
        at = h >> U64(self.shift)
        return (self.bits[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1 > 0


def build(hashes: DataFrame, count: int) -> Bitmap:
    """The bitmap of a column h of count 64-bit hashes, 16 bits or more for each; false positives are one in 16.

    Each piece is made by one small group; hashes are even over them. The caller bounds count, and so the size.
    """
    bits = max(16, int(np.ceil(np.log2(16 * max(1, count)))))
    piece = bits - min(bits, int(np.log2(SPAN * 8)))

    def piece_of(key, batch):
        at = batch.column("h").to_numpy().view(U64) >> U64(64 - bits)
        low = at & U64((1 << (bits - piece)) - 1)
        out = np.zeros(1 << (bits - piece), bool)
        out[low.astype(np.int64)] = True
        return pa.table({"k": pa.array([key[0].as_py()], pa.int64()), "b": pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())})

    key = F.shiftrightunsigned("h", 64 - piece) if piece else F.lit(0).cast("long")
    got = hashes.select("h", key.alias("k")).groupBy("k").applyInArrow(piece_of, "k long, b binary").collect()
    out = np.zeros((1 << piece, (1 << (bits - piece)) // 8), np.uint8)
    for r in got:
        out[r["k"]] = np.frombuffer(r["b"], np.uint8)
    return Bitmap(64 - bits, out.reshape(-1))
