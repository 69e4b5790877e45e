"""SimHash votes of terms on bits, as plain aggregates.

Two counters share a long: a term's hash, shifted by k and masked to bits 0 and 32, adds its bits k and k + 32 at once.
32 sums count the votes on all 64 bits, exactly up to a total weight of 2**31 per document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF


def vote_sums(hashed: Column, weight: Column | None = None, name: str = "v") -> list[Column]:
    """32 sums, ``v0`` to ``v31``, over the term hashes of a group; null hashes do not vote."""
    out = []
    for k in range(32):
        bits = F.shiftrightunsigned(hashed, k).bitwiseAND(F.lit(_LANES))
        out.append(F.sum(bits if weight is None else bits * weight).alias(f"{name}{k}"))
    return out


def majority(total: Column, name: str = "v") -> Column:
    """The fingerprint: a bit is set if terms of more than half the total weight have it. No terms: zero."""

    def decided(k: int) -> list[Column]:
        low = F.col(f"{name}{k}").bitwiseAND(F.lit(_LOW))
        high = F.shiftrightunsigned(F.col(f"{name}{k}"), 32)
        return [
            F.when(votes * 2 > total, F.lit(1 << bit if bit < 63 else -(1 << 63))).otherwise(F.lit(0).cast("long"))
            for votes, bit in ((low, k), (high, k + 32))
        ]

    bits = [bit for k in range(32) for bit in decided(k)]
    # A balanced tree of ORs keeps the expression shallow.
    while len(bits) > 1:
        bits = [reduce(lambda a, b: a.bitwiseOR(b), bits[i : i + 2]) for i in range(0, len(bits), 2)]
    return bits[0]


def differing(left: Column, right: Column) -> Column:
    """Hamming distance of two fingerprints."""
    return F.bit_count(left.bitwiseXOR(right))
