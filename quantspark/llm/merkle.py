"""Merkle manifest of a table as a tree of SHA-256 midstates.

Rows are leaves; per group, runs of ``ARITY`` consecutive nodes become their
parent, up to a subroot; the subroots make the top of the tree.  A parent keeps
a copy of its hash state before each child slot, so a changed child is folded
in by taking up the state of its slot and hashing the replacement and the
siblings to its right; nothing to the left is read again.

A task handles whole subtrees of ``BLOCK`` nodes (``LEVELS`` levels), dealt by
(group, block of positions): a group of any size is spread evenly.  Rows leave
their subtree with the folded digest and the running hash of their siblings;
the levels above hold 1 / BLOCK of the nodes each time, and every block takes
its whole way up with it in one join.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm import sha_state as sha
from quantspark.llm.common import stored
from quantspark.operators.ordered import BLK, IDX, ranged, with_position

ARITY, LEVELS = 8, 4
BLOCK = ARITY**LEVELS
CHUNK_ROWS = 4 * BLOCK
# One level of a stored way up: slot, number of children, state before the slot, all children.
_STEP = np.dtype([("slot", "u1"), ("k", "u1"), ("state", "<u4", (8,)), ("kids", "u1", (ARITY, 32))])

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _item(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (32 bytes) of the values: ``-`` for null, else UTF-8 length, colon, value."""
    return F.unhex(F.sha2(F.concat(*[_item(v) for v in values]).cast("binary"), 256))


def _bytes(column, dtype, width: int) -> np.ndarray:
    """A column of equally long binary values as an array, one row each."""
    import pyarrow as pa
    column = column.cast(pa.large_binary())
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offs[0]:offs[-1]].view(dtype).reshape(len(column), width)


def _binary(rows: np.ndarray):
    """Rows of an array as binary values."""
    import pyarrow as pa
    raw = np.ascontiguousarray(rows).reshape(len(rows), -1).view(np.uint8)
    offs = np.arange(len(rows) + 1, dtype=np.int64) * raw.shape[1]
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offs), pa.py_buffer(raw)]
                                 ).cast(pa.binary())


def _heads(tree, block: np.ndarray) -> np.ndarray:
    """True where a row starts another (tree, block) than the row before."""
    import pyarrow.compute as pc
    head = np.ones(len(block), dtype=bool)
    if len(block) > 1:
        head[1:] = ((block[1:] != block[:-1])
                    | pc.not_equal(tree.slice(1), tree.slice(0, len(block) - 1)).to_numpy(zero_copy_only=False))
    return head


def _depth(total: np.ndarray) -> np.ndarray:
    """Levels that a block of a tree of so many nodes climbs."""
    left, depth = np.minimum(total, BLOCK), np.zeros(len(total), dtype=np.int64)
    while (left > 1).any():
        depth += left > 1
        left = -(-left // ARITY)
    return depth


def _climb(digest: np.ndarray, block: np.ndarray, at: np.ndarray, depth: np.ndarray):
    """Per level (node of each row, parent, slot and liveness of each node, children counts, states, children),
    then the digests of the block tops.  Rows are sorted; ``at`` is a row's index in its block."""
    node = np.arange(len(digest))
    for level in range(LEVELS):
        live = depth[block] > level
        if not live.any():
            break
        first = ~live | (at % ARITY == 0)
        parent = np.cumsum(first) - 1
        slot = np.where(live, at % ARITY, 0)
        k = np.bincount(parent)
        kids = np.zeros((len(k), ARITY, 32), dtype=np.uint8)
        kids[parent, slot] = digest
        states = np.zeros((len(k), ARITY + 1, 8), dtype=np.uint32)
        states[:, 0] = sha.START
        rising = live[first]
        for j in range(ARITY):
            has = np.flatnonzero(rising & (k > j))
            states[has, j + 1] = sha.absorb(states[has, j], kids[has, j])
        digest = kids[:, 0].copy()
        made = np.flatnonzero(rising)
        digest[made] = sha.finish(states[made, k[made]], k[made])
        yield node, parent, slot, live, k, states, kids
        node, block, at = parent[node], block[first], at[first] // ARITY
    yield digest


def _fold(folded, proof, taken, rows, state, slot, k, kids, of):
    """Fold ``rows`` one level up in place: resume ``state`` with the row's digest and its right siblings,
    and hash all its siblings (``kids[of]``) on to ``proof``."""
    s = sha.absorb(state, folded[rows])
    for j in range(1, ARITY):
        more = np.flatnonzero(slot + j < k)
        if not len(more):
            break
        s[more] = sha.absorb(s[more], kids[of[more], slot[more] + j])
    folded[rows] = sha.finish(s, k)
    q = proof[rows]
    for j in range(ARITY):
        other = np.flatnonzero((j < k) & (j != slot))
        if len(other):
            q[other] = sha.absorb(q[other], kids[of[other], j])
    proof[rows] = q
    taken[rows] += k - 1


def _whole_blocks(batches):
    """Tables of about ``CHUNK_ROWS`` rows from batches sorted by tree, pos; a table ends where a block does."""
    import pyarrow as pa
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows >= CHUNK_ROWS:
            held = held.combine_chunks()
            head = _heads(held["tree"].combine_chunks(), held["pos"].to_numpy() // BLOCK)
            cut = int(np.flatnonzero(head)[-1])
            if cut:
                yield held.slice(0, cut).combine_chunks()
                held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _layout(t):
    """(digests, block number, index in the block, depth of each block, block heads) of a table of whole blocks."""
    pos = t["pos"].to_numpy()
    head = _heads(t["tree"].combine_chunks(), pos // BLOCK)
    return (_bytes(t["digest"].combine_chunks(), np.uint8, 32), np.cumsum(head) - 1, pos % BLOCK,
            _depth(t["total"].to_numpy()[head]), head)


def _tops(head: np.ndarray, digest: np.ndarray):
    import pyarrow as pa
    out = np.full(len(head), None, dtype=object)
    out[head] = [x.tobytes() for x in digest]
    return pa.array(out, pa.binary())


def _dealt(nodes: DataFrame) -> DataFrame:
    return (nodes.repartition("tree", F.floor(F.col("pos") / BLOCK)).sortWithinPartitions("tree", "pos"))


def _leaf_tier(leaves: DataFrame, id_type: str) -> DataFrame:
    """Leaves folded to the top of their block: folded, proof (state), taken; top on the block's first row."""
    import pyarrow as pa

    def run(batches):
        for t in _whole_blocks(batches):
            digest, block, at, depth, head = _layout(t)
            folded = _bytes(t["new"].combine_chunks(), np.uint8, 32).copy()
            proof, taken = sha.start(len(digest)), np.zeros(len(digest), dtype=np.int64)
            for found in _climb(digest, block, at, depth):
                if isinstance(found, np.ndarray):
                    break
                node, parent, slot, live, k, states, kids = found
                rows = np.flatnonzero(live[node])
                p, s = parent[node[rows]], slot[node[rows]]
                _fold(folded, proof, taken, rows, states[p, s], s, k[p], kids, p)
            yield from pa.table([t["tree"], t["pos"], t["total"], t["doc_id"], t["digest"], _binary(folded),
                                 _binary(proof), pa.array(taken), _tops(head, found)],
                                names=["tree", "pos", "total", "doc_id", "leaf", "folded", "proof", "taken", "top"]
                                ).to_batches(max_chunksize=1 << 14)

    return _dealt(leaves.select("tree", "pos", "total", "doc_id", "digest", "new")).mapInArrow(
        run, f"tree string, pos bigint, total bigint, doc_id {id_type}, leaf binary, folded binary, proof binary, "
             "taken bigint, top binary")


def _node_tier(nodes: DataFrame) -> DataFrame:
    """Nodes with their way to the top of their block (``_STEP`` records one after the other) and the tops."""
    import pyarrow as pa

    def run(batches):
        for t in _whole_blocks(batches):
            digest, block, at, depth, head = _layout(t)
            way = np.zeros((len(digest), LEVELS), dtype=_STEP)
            levels = 0
            for found in _climb(digest, block, at, depth):
                if isinstance(found, np.ndarray):
                    break
                node, parent, slot, live, k, states, kids = found
                p, s = parent[node], slot[node]
                step = way[:, levels]
                step["slot"], step["k"] = s, np.where(live[node], k[p], 0)
                step["state"], step["kids"] = states[p, s], kids[p]
                levels += 1
            paths = pa.array([w[:n].tobytes() for w, n in zip(way, depth[block])], pa.binary())
            yield from pa.table([t["tree"], t["pos"], t["total"], paths, _tops(head, found)],
                                names=["tree", "pos", "total", "path", "top"]).to_batches(max_chunksize=1 << 12)

    return _dealt(nodes.select("tree", "pos", "total", "digest")).mapInArrow(
        run, "tree string, pos bigint, total bigint, path binary, top binary")


def _above(tier: DataFrame) -> DataFrame:
    return tier.filter(F.col("pos") % BLOCK == 0).select(
        "tree", F.floor(F.col("pos") / BLOCK).alias("pos"),
        F.ceil(F.col("total") / BLOCK).alias("total"), F.col("top").alias("digest"))


def _ways_up(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((tree, pos, path) of every node up to its tree's root, (tree, root)).  A round has 1 / BLOCK of the
    nodes of the one before."""
    tiers = []
    while True:
        tiers.append(stored(_node_tier(nodes)))
        nodes = _above(tiers[-1])
        if nodes.filter("total > 1").isEmpty():
            break
    full = tiers[-1].select("tree", "pos", "path")
    for tier in reversed(tiers[:-1]):
        upper = full.toDF("tree", "block", "upper")
        full = (tier.withColumn("block", F.floor(F.col("pos") / BLOCK)).join(upper, ["tree", "block"])
                .select("tree", "pos", F.concat("path", "upper").alias("path")))
    return full, nodes.select("tree", F.col("digest").alias("root"))


def _finished(rows: DataFrame, id_type: str) -> DataFrame:
    """Rows folded on along their block's way up (``path``)."""
    import pyarrow as pa

    def run(batches):
        for t in _whole_blocks(batches):
            head = _heads(t["tree"].combine_chunks(), t["pos"].to_numpy() // BLOCK)
            of = np.cumsum(head) - 1
            paths = [np.frombuffer(p.as_py(), _STEP) for p in t["path"].filter(pa.array(head))]
            folded = _bytes(t["folded"].combine_chunks(), np.uint8, 32).copy()
            proof = _bytes(t["proof"].combine_chunks(), np.uint32, 8).copy()
            taken = t["taken"].to_numpy().copy()
            for level in range(max(map(len, paths))):
                step = np.array([p[level] if level < len(p) else np.zeros((), _STEP) for p in paths], dtype=_STEP)
                rows = np.flatnonzero(step["k"][of] > 0)
                mine = of[rows]
                _fold(folded, proof, taken, rows, step["state"][mine], step["slot"][mine].astype(np.int64),
                      step["k"][mine].astype(np.int64), step["kids"], mine)
            yield from pa.table([t["doc_id"], t["leaf"], t["subroot"], _binary(sha.finish(proof, taken)),
                                 _binary(folded)], names=["doc_id", "leaf", "subroot", "proof", "folded"]
                                ).to_batches(max_chunksize=1 << 14)

    return (rows.select("tree", "pos", "doc_id", "leaf", "folded", "proof", "taken", "path", "subroot")
            .mapInArrow(run, f"doc_id {id_type}, leaf binary, subroot binary, proof binary, folded binary"))


def _numbered(leaves: DataFrame) -> DataFrame:
    """Leaves with their position in their tree and the tree's size.

    Range blocks are sorted by (tree, id); what comes before a (block, tree)
    is a sum over one row for each, so a tree of any size is no hot key."""
    rng = ranged(leaves, ["tree", "doc_id", "digest", "new"])
    parts = rng.groupBy(BLK, "tree").agg(F.count(F.lit(1)).alias("n"), F.min(IDX).alias("low"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(parts.select(BLK, "tree", F.sum("n").over(tree).alias("total"),
                                (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift")))
    return rng.join(parts, [BLK, "tree"]).withColumn("pos", F.col("shift") + F.col(IDX)).drop(BLK, IDX, "shift")


def merkle_manifest(docs: DataFrame, changed: dict[str, Column] | None = None, fields: Sequence[str] = FIELDS,
                    id_col: str = "doc_id", group_col: str = "lang") -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, digests as lowercase hex.

    ``fields`` make the leaf.  ``changed`` gives columns another value (a null
    there means null) to be checked against the manifest of the original ones:
    folded_root is the root that the changed leaf and the original siblings
    give, verified whether it is the manifest's.  Groups come in order of
    their UTF-8 bytes, null first; leaves by id, null first, rows of one id by
    their digest.  Repeated rows are leaves of their own.  Other columns play
    no part; an empty table gives an empty result.
    """
    c = lambda name: F.col(f"`{name}`")
    id_type = dict(docs.dtypes)[id_col]
    group = c(group_col).cast("string")
    new = [(changed or {}).get(f, c(f)) for f in fields]
    leaves = docs.select(
        F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group)).alias("tree"),
        c(id_col).alias("doc_id"), leaf_digest([c(f) for f in fields]).alias("digest"),
        leaf_digest(new).alias("new"))
    tier = stored(_leaf_tier(_numbered(leaves), id_type))
    blocks, subroots = _ways_up(_above(tier))
    trees = stored(with_position(subroots.select(F.col("tree").alias("name"), "root"), ["name"])
                   .select("name", F.col("root").alias("digest"), F.col("_pos").alias("pos")))
    tops, root = _ways_up(trees.select(F.lit("").alias("tree"), "pos", F.lit(trees.count()).cast("bigint")
                                       .alias("total"), "digest"))
    last = root.select(F.lower(F.hex("root")).alias("root")).first()
    crown = (trees.join(tops.select("pos", F.col("path").alias("crown")), "pos")
             .select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "crown"))
    ways = stored(blocks.join(crown, "tree").select("tree", F.col("pos").alias("block"),
                                                    F.concat("path", "crown").alias("path"), "subroot"))
    rows = tier.withColumn("block", F.floor(F.col("pos") / BLOCK)).join(ways, ["tree", "block"])
    h = lambda x: F.lower(F.hex(x))
    return _finished(rows, id_type).select(
        "doc_id", h("leaf").alias("leaf"), h("subroot").alias("subroot"),
        F.lit(last["root"] if last else None).cast("string").alias("root"), h("proof").alias("proof_sha256"),
        h("folded").alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
