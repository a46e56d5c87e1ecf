"""Exact top-k inner-product search by distributed histogram selection.

Queries and candidates are hashed into blocks; each pair of blocks is one
matrix product.  Rounds of global score histograms narrow the interval that
holds each query's k-th best score: a block reports its fullest bins from the
top until they hold the wanted rank, the counts are added over blocks, and
the bin with the rank becomes the next interval, until it is one score wide.
A last pass keeps the scores above that value and, among equals, the smallest
ids.  No round sends more than k rows per query and block.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm.common import stored

SCALE = 1024
K = 10
BINS = 1024
QUERY_BLOCK = 512
ROW_BLOCK = 8192
SCORE_LIMIT = 2**63 - 2     # a score beyond it is an error


def scaled_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   scale: int = SCALE) -> DataFrame:
    """(vec_id, v, copies): floor(scale * x) per component, as whole doubles, and the rows that are equal in both.
    Rows with a null id, a null vector, or a null or non-finite component take no part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    # From 2^52 on every double is whole.
    v = F.transform(x, lambda e: F.when(F.abs(e * scale) < 2.0**52, F.floor(e * scale).cast("double"))
                    .otherwise(e * scale))
    return (table.filter(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{vector_col}`").isNotNull() & fine)
            .select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), v.alias("v"))
            .groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies")))


def _wrapped(x: np.ndarray) -> np.ndarray:
    """Whole doubles as integers modulo 2^64."""
    far = np.abs(x) >= 2.0**63
    out = np.where(far, 0.0, x).astype(np.int64)
    out[far] = [(int(v) + 2**63) % 2**64 - 2**63 for v in x[far]]
    return out


def _scores(q: np.ndarray, c: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact integer products of whole doubles; pairs marked ``own`` do not count.

    Where no partial sum can pass 2^53 the product in doubles is exact.  Else it is taken modulo 2^64, which is
    exact if it fits, and in Python integers where the doubles do not tell that it does."""
    if q.size == 0 or c.size == 0:
        return np.zeros((len(q), len(c)), dtype=np.int64)
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.sqrt(q.shape[1]) * np.abs(q).max(axis=1), np.sqrt(q.shape[1]) * np.abs(c).max(axis=1)
        if size[0].max() * size[1].max() < 2.0**53:
            return (q @ c.T).astype(np.int64)
        s = np.zeros((len(q), len(c)), dtype=np.int64)
        qi, ci = _wrapped(q), _wrapped(c)
        for i in range(len(q)):
            far = size[0][i] * size[1] >= 2.0**53
            s[i, ~far] = (c[~far] @ q[i]).astype(np.int64)
            s[i, far] = ci[far] @ qi[i]
            about, slack = c[far] @ q[i], size[0][i] * size[1][far] * (q.shape[1] * 2.0**-52)
            for j in np.flatnonzero(far)[~(np.abs(about) + slack < 2.0**62)]:
                if own[i, j]:
                    continue
                exact = sum(int(a) * int(b) for a, b in zip(q[i].tolist(), c[j].tolist()))
                if abs(exact) > SCORE_LIMIT:
                    raise OverflowError(f"inner product {exact} does not fit 64 bits")
                s[i, j] = exact
    return s


def _pairs(queries: DataFrame, rows: DataFrame, nq: int, nc: int, visit, schema: str) -> DataFrame:
    """Cogroup every query block with every row block of the same dimension; ``visit(q, c, scores)`` sees
    one pair, with the query's own rows marked by the smallest integer."""
    import pandas as pd

    def run(_, q, c):
        if not len(q) or not len(c):
            return pd.DataFrame(columns=names)
        c = c.sort_values("vec_id", kind="stable")
        qv, cv = (np.array(list(x["v"]), dtype=float).reshape(len(x), -1) for x in (q, c))
        own = q["vec_id"].to_numpy()[:, None] == c["vec_id"].to_numpy()[None, :]
        s = _scores(qv, cv, own)
        s[own] = np.iinfo(np.int64).min
        out = visit(q, c, s)
        return pd.DataFrame(dict(zip(names, out)), columns=names)

    names = [p.strip().split(" ")[0] for p in schema.split(",")]
    q = queries.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nc - 1))))
    c = rows.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    keys = ["qb", "cb", "dim"]
    return q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(run, schema)


def top_k(table: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE, bins: int = BINS, query_block: int = QUERY_BLOCK,
          row_block: int = ROW_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows by integer inner product.

    ``is_query`` is a condition on ``vec_id``.  All rows but those under the
    query's own id are candidates, repeated rows as often as they occur;
    vectors only meet vectors of their length.  A score that does not fit 64
    bits is an error.  Equal scores rank by the smaller id.  Queries with fewer than k
    candidates return them all; an id with several vectors asks once per vector.
    """
    rows = stored(scaled_vectors(table, id_col, vector_col, scale).withColumn("dim", F.size("v")))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("int")).alias("q"), F.max("dim").alias("d"),
                    F.max(F.array_max(F.transform("v", F.abs))).alias("m")).first()
    n, nq_rows = size["n"], size["q"] or 0
    nc, nq = max(1, -(-n // row_block)), max(1, -(-nq_rows // query_block))
    # Seeded by the vector too: blocks stay even when one id repeats.
    rows = rows.withColumn("cb", F.pmod(F.xxhash64("vec_id", "v"), F.lit(nc)).cast("int"))
    queries = (rows.filter(is_query).drop("copies").withColumn("qb", F.pmod(F.xxhash64("v", "vec_id"), F.lit(nq)).cast("int"))
               .withColumn("q", F.xxhash64("vec_id", "v")).drop("cb"))
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])   # columns of its own

    bound = min(int(size["m"] or 0) ** 2 * int(size["d"] or 0), SCORE_LIMIT)
    width, low = 1, -bound
    while width < 2 * bound + 1:
        width *= bins
    # state: the interval [low, low + width) holds the k-th value, as its need-th largest inside
    state = queries.select("q", F.lit(low).cast("bigint").alias("low"), F.lit(k).cast("bigint").alias("need"))
    while width > 1:
        step = width // bins

        def count(q, c, s, step=step, width=width):
            ids, at, tally, copies = [], [], [], c["copies"].to_numpy()
            for i, (key, lo, need) in enumerate(zip(q["q"], q["low"], q["need"])):
                pick = s[i] >= lo
                x = s[i][pick].view(np.uint64) - np.array(lo, dtype=np.int64).view(np.uint64)    # may pass 2^63
                inside = x < width
                x, m = x[inside] // np.uint64(step), copies[pick][inside]
                if not len(x) or need <= 0:
                    continue
                x = x.astype(np.int64)
                top = np.partition(x, max(0, len(x) - need))[max(0, len(x) - need):].min()
                b, back = np.unique(x[x >= top], return_inverse=True)
                ids += [key] * len(b)
                at += b.tolist()
                tally += np.bincount(back, weights=m[x >= top]).astype(np.int64).tolist()
            return ids, at, tally

        found = _pairs(queries.join(state, "q"), rows, nq, nc, count, "q long, bin long, n long")
        found = found.groupBy("q", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("q").orderBy(F.desc("bin"))
        found = found.withColumn("above", F.sum("n").over(down) - F.col("n"))
        hit = found.join(state, "q").filter((F.col("above") < F.col("need"))
                                            & (F.col("above") + F.col("n") >= F.col("need")))
        # A query with fewer candidates than k has no such bin: its interval drops below all scores.
        state = stored(state.join(hit.select("q", "bin", "above"), "q", "left").select(
            "q", F.coalesce(F.col("low").cast("decimal(20,0)") + F.col("bin").cast("decimal(5,0)") * F.lit(step),
                            F.lit(-bound - 1)).cast("bigint").alias("low"),
            F.coalesce(F.col("need") - F.col("above"), F.lit(0)).cast("bigint").alias("need")))
        width = step

    def best(q, c, s):
        ids, vec, score, own = [], [], [], []
        vec_ids, copies = c["vec_id"].to_numpy(), c["copies"].to_numpy()          # ids ascend
        for i, (key, lo, own_id) in enumerate(zip(q["q"], q["low"], q["vec_id"])):
            x = s[i]
            pick = np.concatenate([np.flatnonzero(x > lo), np.flatnonzero(x == lo)[:k]])
            pick = pick[x[pick] > np.iinfo(np.int64).min]
            pick = np.repeat(pick, np.minimum(copies[pick], k))
            ids += [key] * len(pick)
            own += [own_id] * len(pick)
            vec += vec_ids[pick].tolist()
            score += x[pick].tolist()
        return ids, own, vec, score

    kept = _pairs(queries.join(state, "q"), rows, nq, nc, best, "q long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
