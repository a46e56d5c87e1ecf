"""Near-duplicate groups by tensored MinHash banding with exact verification.

A document's set is its distinct word shingles.  Documents with equal sets
form one class; only classes are compared.  A class gets ``HALVES`` half-bands
of ``DEPTH`` minhashes each, and every pair of half-bands is one table key:
HALVES * DEPTH minhashes serve HALVES * (HALVES - 1) / 2 tables of 2 * DEPTH
hashes, about the square root of what separate tables would need.  Two classes
meet when at least two half-bands agree (probability 0.9993 at similarity
0.75, 0.99999 at 0.8).

Keys are hash-partitioned and sorted; a bucket is a run of rows, read as a
stream.  First every member of a bucket meets the bucket's lead, mostly the
same few classes in every table; links confirmed on the full sets merge
classes into components.  Then only classes of one bucket whose components
still differ are compared, block against block inside tasks.  So a group of
thousands of near copies costs a row per member and table, no pair is a row
unless it is linked or has a bucket's lead, and no candidate is dropped.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.llm import textvec as tv
from quantspark.llm.common import stored
from quantspark.llm.components import connected_components

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
HALVES, DEPTH = 18, 3
BLOCK, MINORS = 512, 256
SALTS = 16

_PLACE = tv.mix(np.arange(64, dtype=np.uint64), 11) | np.uint64(1)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all rows, ascending inside a row; row borders).  A-Z count as a-z;
    a row with fewer than ``k`` words has its whole sequence as one shingle, a wordless row has none."""
    rows = len(offs) - 1
    starts, ends, row = tv.word_spans(buf, offs)
    words = tv.span_hashes(buf, starts, ends)
    first = np.searchsorted(row, np.arange(rows + 1))
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(int(at[-1]), dtype=np.uint64)
    full = n >= k
    if full.any():
        place = np.repeat(first[:-1][full] - (np.cumsum(count[full]) - count[full]), count[full])
        place = place + np.arange(int(count[full].sum()))
        s = words[place] * _PLACE[0]
        for j in range(1, k):
            s += words[place + j] * _PLACE[j]
        out[np.repeat(full, count)] = tv.mix(s, 5)
    for r in np.flatnonzero((n > 0) & ~full):
        w = words[first[r]:first[r + 1]]
        out[at[r]] = tv.mix((w * _PLACE[:len(w)]).sum(dtype=np.uint64) + np.uint64(len(w)), 6)
    for r in range(rows):
        out[at[r]:at[r + 1]].sort()
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = out[1:] != out[:-1]
    keep[at[:-1][count > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], kept[at]


def _signatures(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Minhashes (rows x HALVES*DEPTH, 32 bits); wordless rows are all ones."""
    n = np.diff(at)
    out = np.full((len(n), HALVES * DEPTH), 0xFFFFFFFF, dtype=np.uint32)
    some = n > 0
    if some.any():
        for j in range(HALVES * DEPTH):
            factor = tv.mix(np.uint64(j), 21) | np.uint64(1)
            out[some, j] = np.minimum.reduceat(sets * factor, at[:-1][some]) >> np.uint64(32)
    return out


def _sum_hash(sets: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tv.mix(sets, seed), dtype=np.uint64)])
    return (total[at[1:]] - total[at[:-1]]).view(np.int64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, sig): set size, 128-bit set hash and minhashes of every row."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            buf, offs = tv.arrow_text(batch.column(1))
            for a, b in tv.slices(offs):
                sets, at = shingle_sets(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                sig = _signatures(sets, at).tobytes()
                width = HALVES * DEPTH * 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(at)), pa.array(_sum_hash(sets, at, 1)),
                     pa.array(_sum_hash(sets, at, 2)),
                     pa.array([sig[i * width:(i + 1) * width] for i in range(b - a)], pa.binary())],
                    names=["doc_id", "n_shingles", "h1", "h2", "sig"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(tv.released(run), f"doc_id {kind}, n_shingles bigint, h1 bigint, h2 bigint, sig binary"))


def _half_bands(sig) -> np.ndarray:
    """One hash per half-band (rows x HALVES) of a column of signatures."""
    rows = np.frombuffer(b"".join(sig.to_pylist()), dtype=np.uint32).reshape(len(sig), HALVES, DEPTH)
    return tv.mix((rows.astype(np.uint64) * _PLACE[:DEPTH]).sum(axis=2, dtype=np.uint64), 31)


def _table_keys(classes: DataFrame) -> DataFrame:
    """(key, node, size): one row per class and pair of half-bands."""
    import pyarrow as pa
    left, right = np.triu_indices(HALVES, 1)

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                batch = whole.slice(lo, 2048)
                half = _half_bands(batch.column(2))
                key = tv.mix(half[:, left] * _PLACE[8] + half[:, right] * _PLACE[9]
                             + np.arange(len(left), dtype=np.uint64), 32)
                node, size = (np.repeat(batch.column(i).to_numpy(), len(left)) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(node), pa.array(size)],
                                                 names=["key", "node", "size"])

    return classes.select("node", "n_shingles", "sig").mapInArrow(tv.released(run), "key bigint, node bigint, size bigint")


def _alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can be linked at all."""
    return np.minimum(x, y) * DENOMINATOR >= np.maximum(x, y) * NUMERATOR


def _shared_buckets(keys: DataFrame) -> DataFrame:
    """(key, node, size): the members of buckets of two classes or more.  Sorted partitions are read as a
    stream; the last row of a batch waits for the next one."""
    import pyarrow as pa

    def run(batches):
        held, known = None, False                         # last row, whether its bucket is shared already
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(3)]
            if held is not None:
                cols = [np.append(h, c) for h, c in zip(held, cols)]
            same = cols[0][1:] == cols[0][:-1]
            keep = np.append(False, same) | np.append(same, False)
            keep[0] |= known
            known = bool(keep[-1])
            held = [c[-1:] for c in cols]
            at = np.flatnonzero(keep[:-1])
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(c[at]) for c in cols], names=["key", "node", "size"])
        if known:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=["key", "node", "size"])

    return (keys.repartition("key").sortWithinPartitions("key")
            .mapInArrow(tv.released(run), "key bigint, node bigint, size bigint"))


def _with_leads(shared: DataFrame) -> DataFrame:
    """Each row with its bucket's lead and the lead's size: the member that is in the most buckets, so that a
    group of near copies has the same few leads everywhere."""
    degree = shared.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    rows = shared.join(degree, "node")
    lead = rows.groupBy("key").agg(F.max_by(F.struct("node", "size"), F.struct("degree", -F.col("node"))).alias("l"))
    return (rows.join(lead, "key")
            .select("key", "node", "size", F.col("l.node").alias("lead"), F.col("l.size").alias("lead_size")))


def _sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, s): the full shingle set of each class in ``nodes``, read anew from its document."""
    import pyarrow as pa

    def sets(batches):
        for batch in batches:
            buf, offs = tv.arrow_text(batch.column(3))
            for a, b in tv.slices(offs):
                own, at = shingle_sets(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                # Another row under the same id is not the class's text.
                right = ((_sum_hash(own, at, 1) == batch.column(1).to_numpy()[a:b])
                         & (_sum_hash(own, at, 2) == batch.column(2).to_numpy()[a:b]))
                values = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(own.view(np.int64)))
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), values], names=["node", "s"])
                yield out.filter(pa.array(right))

    wanted = nodes.distinct().join(classes.select("node", "doc_id", "h1", "h2"), "node")
    text = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return stored(wanted.join(text, "doc_id").select("node", "h1", "h2", "text")
                  .mapInArrow(tv.released(sets), "node bigint, s array<bigint>"))


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = _common(x, y)
    return both * DENOMINATOR >= (len(x) + len(y) - both) * NUMERATOR


def _verified(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full sets (``own``: node, s) have enough in common."""
    import pyarrow as pa

    def check(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            lo, ro = left.offsets.to_numpy(), right.offsets.to_numpy()
            lv, rv = left.values.to_numpy(), right.values.to_numpy()
            ok = [_linked(lv[lo[i]:lo[i + 1]], rv[ro[i]:ro[i + 1]]) for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return (pairs.join(own.toDF("a", "sa"), "a").join(own.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
            .mapInArrow(tv.released(check), "a bigint, b bigint").distinct())


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two arrays of distinct values."""
    z = np.concatenate([x, y])
    z.sort()
    return int((z[1:] == z[:-1]).sum())


def _open_links(shared: DataFrame, component: DataFrame, classes: DataFrame, own: DataFrame) -> DataFrame:
    """Links (a, b) between classes of one bucket whose components differ.

    A bucket's lead has met the others already, so only buckets whose
    other members belong to several components matter.  They are gathered by
    their most frequent component: the classes outside it (minors) meet every
    class of these buckets, blocks of about ``MINORS`` against blocks of about
    ``BLOCK``, dealt by a hash.  Inside a task, pairs that share a bucket are
    compared on their full sets; only confirmed links leave it.
    """
    import pyarrow as pa

    rows = shared.filter("node != lead").select("key", "node").join(component, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"))
    share = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = (share.groupBy("key").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("cluster"),
                                     F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("key", "cluster"))
    rows = stored(rows.join(main, "key").select("cluster", "node", "component").distinct())
    minor = F.col("component") != F.col("cluster")
    counts = stored(rows.groupBy("cluster").agg(
        F.ceil(F.count(F.when(minor, 1)) / MINORS).cast("int").alias("minors"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")))
    rows = rows.join(own, "node").join(classes.select("node", "sig"), "node").join(counts, "cluster")
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    columns = ["cluster", "node", "component", "sig", "s"]
    asked = rows.filter(minor).select(*columns, deal("minors").alias("i"), F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(True).alias("asks"))
    every = rows.select(*columns, F.explode(F.sequence(F.lit(0), F.col("minors") - 1)).alias("i"),
                        deal("blocks").alias("j"), F.lit(False).alias("asks"))

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        node, comp = t["node"].to_numpy(), t["component"].to_numpy()
        half = _half_bands(t["sig"].combine_chunks())
        sets = t["s"].combine_chunks()
        at, values = sets.offsets.to_numpy(), sets.values.to_numpy()
        size = np.diff(at)
        asks = t["asks"].to_numpy(zero_copy_only=False)
        y = np.flatnonzero(~asks)
        a, b = [], []
        for i in np.flatnonzero(asks):
            z = y[_alike(size[y], size[i]) & (comp[y] != comp[i])]
            for k in z[(half[z] == half[i]).sum(axis=1) >= 2]:
                if _linked(values[at[i]:at[i + 1]], values[at[k]:at[k + 1]]):
                    a.append(int(node[i]))
                    b.append(int(node[k]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return (asked.unionByName(every).groupBy("cluster", "i", "j").applyInArrow(compare, "a bigint, b bigint")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _components(classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, component) of the classes that have a link; the component is its smallest node."""
    shared = stored(_with_leads(stored(_shared_buckets(_table_keys(classes)))))
    alike = (F.least("size", "lead_size") * DENOMINATOR >= F.greatest("size", "lead_size") * NUMERATOR)
    own = _sets_of(shared.select("node"), classes, docs, id_col, text_col)
    pairs = shared.filter((F.col("node") != F.col("lead")) & alike).select(F.col("lead").alias("a"),
                                                                           F.col("node").alias("b"))
    links = stored(_verified(stored(pairs.distinct()), own))
    label = connected_components(links)
    more = stored(_open_links(shared, label, classes, own))
    return label if more.isEmpty() else connected_components(links.union(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    ``component_id`` is the smallest id reachable over links (100 * common
    >= 75 * union of the full sets).  Rows without words link with nothing.
    Rows with a null id have no identity to link by: component null, kept.
    Rows that repeat an id with other text take the smallest component of
    that id's classes only through their own set.  An empty table gives an
    empty result; ids may be of any ordered type.
    """
    prints = stored(fingerprints(docs, id_col, text_col))
    shape = ["h1", "h2", "n_shingles"]
    # Nodes are numbered by id, so a component's smallest node has its smallest id.
    classes = stored(prints.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).groupBy(*shape)
                     .agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"))
                     .orderBy("doc_id", "h1", "h2").withColumn("node", F.monotonically_increasing_id()))
    label = _components(classes, docs, id_col, text_col)
    # A component may hold many classes: its name is spread over SALTS keys.
    roots = stored(label.filter("node = component").join(classes.select("node", "doc_id"), "node")
                   .select("component", F.col("doc_id").alias("component_id"),
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    named = (label.withColumn("salt", F.pmod("node", F.lit(SALTS)).cast("int")).join(roots, ["component", "salt"])
             .select("node", "component_id"))
    named = classes.join(named, "node", "left").select(*shape, F.coalesce("component_id", "doc_id").alias("component_id"))
    out = prints.drop("sig").join(named, shape, "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one of the smallest id.  Rows with a null id
    and rows without words stay; of rows that repeat an id and its text, one stays."""
    found = stored(near_duplicates(docs, id_col, text_col))
    ids = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    gone = ids.filter(~F.col("kept")).select("doc_id").alias("gone")
    left = docs.alias("docs").join(gone, F.col(f"docs.`{id_col}`") == F.col("gone.doc_id"), "left_anti")
    if ids.filter("doc_id is not null and rows > 1").isEmpty():
        return left
    nulls = left.filter(F.col(f"`{id_col}`").isNull())
    return left.filter(F.col(f"`{id_col}`").isNotNull()).dropDuplicates([id_col, text_col]).unionByName(nulls)
