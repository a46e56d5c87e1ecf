"""Reproducible shuffle into shards: a Feistel permutation of the global row number.

Rows are numbered in a total order (range sort with block offsets).  The
permutation is a mixed-radix Feistel network over a grid of
ceil(sqrt N) x ceil(N / ceil(sqrt N)) cells, which exceeds N by less than one
grid row; positions that land outside walk the cycle until they are inside.
Shard and slot follow from the permuted position by division, so either can be
computed for any row number, and inverted, without touching the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantspark.llm.common import stored
from quantspark.operators.ordered import POS, with_position

N_SHARDS = 40
ROUNDS = 6
SEED = 20261


def grid(n: int) -> tuple[int, int]:
    """(rows, columns) of the Feistel grid: rows * columns >= n, with less than ``rows`` cells to spare."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _once(x: Column, n: int, seed: int, rounds: int, inverse: bool = False) -> Column:
    """One application of the Feistel network to a cell number."""
    a, b = grid(n)
    left, right = F.floor(x / F.lit(b)).cast("bigint"), F.pmod(x, F.lit(b)).cast("bigint")
    cell = F.struct(left.alias("l"), right.alias("r"))
    keys = [(k, seed + k) for k in range(rounds)]

    def step(s: Column, key: Column) -> Column:
        even = F.pmod(key, F.lit(2)) == 0
        shift = F.xxhash64(F.when(even, s["r"]).otherwise(s["l"]), key)
        shift = F.pmod(shift, F.when(even, F.lit(a)).otherwise(F.lit(b)).cast("bigint"))
        shift = -shift if inverse else shift
        return F.struct(F.when(even, F.pmod(s["l"] + shift, F.lit(a).cast("bigint"))).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(F.pmod(s["r"] + shift, F.lit(b).cast("bigint"))).alias("r"))

    order = [k for _, k in (reversed(keys) if inverse else keys)]
    return F.aggregate(F.array(*[F.lit(k).cast("bigint") for k in order]), cell, step,
                       lambda s: s["l"] * F.lit(b).cast("bigint") + s["r"])


def permuted(position: Column, n: int, seed: int = SEED, rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """Permutation of 0..n-1.  A cell outside walks on; the cycle returns inside after at most as many
    steps as there are spare cells, so the walk's array of that length always suffices.  It is only
    evaluated for rows that two plain steps left outside (about one in n)."""
    a, b = grid(n)
    spare, limit = a * b - n, F.lit(n).cast("bigint")
    x = _once(position.cast("bigint"), n, seed, rounds, inverse)
    if spare == 0:
        return x
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(spare)), x,
                       lambda at, _: F.when(at < limit, at).otherwise(_once(at, n, seed, rounds, inverse)))
    return F.when(x < limit, x).otherwise(walk)


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text",
                    seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, row_number, shard, slot) of every row.

    Shard counts differ by one at most and slots are gapless from 0.  Rows
    are numbered by (id, size, crc32), null ids first; rows equal in all three
    are interchangeable.  A null text has size 16 (no bytes) and crc32 0.  An
    empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    slim = stored(docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                              (F.octet_length(text) + 16).cast("bigint").alias("size"),
                              F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32")))
    n = slim.count()
    at = permuted(F.col(POS), n, seed)
    return (with_position(slim, ["doc_id", "size", "text_crc32"])
            .withColumn("_at", at)
            .select("doc_id", "size", "text_crc32", F.col(POS).cast("bigint").alias("row_number"),
                    F.pmod("_at", F.lit(n_shards)).cast("int").alias("shard"),
                    F.floor(F.col("_at") / F.lit(n_shards)).cast("bigint").alias("slot")))


def row_number_at(shard: Column, slot: Column, n: int, n_shards: int = N_SHARDS, seed: int = SEED) -> Column:
    """The row number stored in a shard's slot: the inverse of the shuffle, for random access."""
    return permuted(slot.cast("bigint") * n_shards + shard, n, seed, inverse=True)
