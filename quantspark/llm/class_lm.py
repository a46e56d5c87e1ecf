"""Class-based n-gram scoring: exchange clustering of words, class transitions, word emissions.

P(text) = prod P(class_i | class_i-1) * P(word_i | class_i), both learned from
the training documents.

* Texts are cut into blocks of about ``BLOCK_BYTES`` where they are read.  A
  block keeps its tokens as numbers of its own distinct words, and these words
  (hashes) in parts of the hash range, so that one group of a part sees the
  same words of all blocks.  No vocabulary is ever broadcast or collected.
* Exchange clustering covers every training word.  A sweep counts, block by
  block, the classes before and after each word, adds these counts up part by
  part, and moves each word to the class that raises the corpus likelihood
  most, given the class bigram counts (classes x classes, in every task).  A
  sweep that does not raise the likelihood ends the search and is dropped.
* Words with at least ``FREQUENT`` of all tokens (1 / FREQUENT words at most)
  move one after the other, each seeing the moves before it; words below move
  at the same time, from the counts at the sweep's start.
* A word that never occurs in training has no neighbours to be exchanged by:
  it takes the class that most training words with its last three bytes have.
* Emissions use absolute discounting per class; what it frees is the
  probability of an unknown word of that class.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantspark.llm import textvec as tv
from quantspark.llm.common import dropped, input_bytes, shuffles_freed, stored_at

CLASSES = 48
FREQUENT = 2.0 ** -12
SUFFIX_GROUPS = 1024
SWEEPS = 8
BLOCK_BYTES = 6 << 20
PART_BYTES = 16 << 20
TRANSITION_PRIOR = 10.0
SMALL = 16
FEW = 8
CELLS = 8192

_LOWER_BYTE = np.arange(256, dtype=np.int64)
_LOWER_BYTE[65:91] += 32


def _words(column):
    """Word hashes, suffix groups and row borders of an Arrow text column."""
    buf, offs = tv.arrow_text(column)
    hashes, groups, rows = [], [], []
    for a, b in tv.slices(offs):
        part = buf[offs[a]:offs[b]]
        s, e, row = tv.word_spans(part, offs[a:b + 1] - offs[a])
        hashes.append(tv.span_hashes(part, s, e).view(np.int64))
        code = np.zeros(len(s), dtype=np.int64)
        for back in (1, 2, 3):
            inside = e - back >= s
            code = code * 257 + np.where(inside, _LOWER_BYTE[part[np.maximum(e - back, 0)]] + 1, 0)
        groups.append((tv.mix(code.view(np.uint64), 3) % np.uint64(SUFFIX_GROUPS)).astype(np.int32))
        rows.append(row + a)
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(len(column) + 1, np.int64)
    row = np.concatenate(rows)
    return np.concatenate(hashes), np.concatenate(groups), np.searchsorted(row, np.arange(len(column) + 1))


def _with_ends(values: np.ndarray, at: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Every row's values followed by ``end``, and the new row borders."""
    rows = len(at) - 1
    to = at + np.arange(rows + 1)
    out = np.full(len(values) + rows, end, dtype=np.int64)
    out[np.arange(len(values)) + np.repeat(np.arange(rows), np.diff(at))] = values
    return out, to


def _pack(x: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes, after their width (one byte) and number (eight)."""
    import pyarrow as pa
    x = np.ascontiguousarray(x)
    width = 1 << int(np.searchsorted([8, 16, 32], int(x.max(initial=0)).bit_length(), "left"))
    planes = x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + len(x).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _unpack(b: bytes) -> np.ndarray:
    import pyarrow as pa
    width, n = b[0], int.from_bytes(b[1:9], "little")
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.Codec("zstd").decompress(memoryview(b)[9:], width * n), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def _all(column) -> list[np.ndarray]:
    return [_unpack(x) for x in column.to_pylist()]


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, np.int64)


def _text_blocks(docs: DataFrame, kind: str, part_bits: int) -> DataFrame:
    """Rows of two sorts.  part -1: a block's tokens (0: end of text, i: its i-th word), ids and held-out marks of
    its texts and number of training tokens.  part >= 0: hashes, suffix groups and training counts of the
    block's words in that part of the hash range, ascending."""
    import pyarrow as pa

    def block_rows(number: int, pieces: list):
        t = pa.Table.from_batches(pieces).combine_chunks()
        h, g, at = _words(t["text"].combine_chunks())
        u, first, back = np.unique(h.view(np.uint64), return_index=True, return_inverse=True)
        held = t["held_out"].to_numpy(zero_copy_only=False).astype(bool)
        n = np.bincount(back, weights=np.repeat(~held, np.diff(at)), minlength=len(u)).astype(np.int64)
        seq, _ = _with_ends(back + 1, at, 0)
        part = (u >> np.uint64(64 - part_bits)).astype(np.int64) if part_bits else np.zeros(len(u), np.int64)
        rows = [{"block": number, "part": -1, "doc_id": t["doc_id"].to_pylist(), "held_out": held.tolist(),
                 "tokens": int(n.sum()) + int((~held).sum()), "ids": _pack(seq)}]
        parts, start = np.unique(part, return_index=True)
        for p, a, b in zip(parts, start, [*start[1:], len(u)]):
            rows.append({"block": number, "part": int(p), "h": u[a:b].tobytes(), "g": _pack(g[first[a:b]]),
                         "n": _pack(n[a:b])})
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("block", pa.int64()), ("part", pa.int32()), ("doc_id", pa.list_(t.schema.field("doc_id").type)),
            ("held_out", pa.list_(pa.bool_())), ("tokens", pa.int64()), ("ids", pa.binary()), ("h", pa.binary()),
            ("g", pa.binary()), ("n", pa.binary())]))

    def run(batches):
        number, pieces, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            _, offs = tv.arrow_text(batch.column(1))
            for a, b in tv.slices(offs, BLOCK_BYTES):
                size = int(offs[b] - offs[a])
                if pieces and held + size > BLOCK_BYTES:
                    yield block_rows(number, pieces)
                    number, pieces, held = number + 1, [], 0
                pieces.append(batch.slice(a, b - a))
                held += size
        if pieces:
            yield block_rows(number, pieces)

    return docs.select("doc_id", "text", "held_out").mapInArrow(
        tv.released(run), f"block bigint, part int, doc_id array<{kind}>, held_out array<boolean>, tokens bigint, "
             "ids binary, h binary, g binary, n binary")


def _vocabulary(words: DataFrame, least: int, classes: int) -> DataFrame:
    """Per block and part: each word's number among the part's words (as steps), corpus count, suffix group and first
    class.  Per part, in a row of block -1: how many training words, and the numbers and counts of
    those with ``least`` tokens."""
    import pyarrow as pa

    def run(t: pa.Table) -> pa.Table:
        hs = [np.frombuffer(x, np.uint64) for x in t["h"].to_pylist()]
        u, first, back = np.unique(np.concatenate(hs), return_index=True, return_inverse=True)
        c = np.bincount(back, weights=_joined(_all(t["n"])), minlength=len(u)).astype(np.int64)
        g = _joined(_all(t["g"]))[first]
        k = 1 + g % (classes - 1)
        at = np.concatenate([[0], np.cumsum([len(x) for x in hs])])
        part = t["part"][0].as_py()
        rows = [{"block": -1, "part": part, "types": int((c > 0).sum()),
                 "frequent": np.flatnonzero(c >= least).tolist(), "counts": c[c >= least].tolist()}]
        for block, a, b in zip(t["block"].to_pylist(), at[:-1], at[1:]):
            i = back[a:b]
            rows.append({"block": block, "part": part, "i": _pack(np.diff(i, prepend=0)), "c": _pack(c[i]),
                         "g": _pack(g[i]), "k": _pack(k[i])})
        return pa.Table.from_pylist(rows, schema=pa.schema([
            ("block", pa.int64()), ("part", pa.int32()), ("types", pa.int64()), ("frequent", pa.list_(pa.int64())),
            ("counts", pa.list_(pa.int64())), ("i", pa.binary()), ("c", pa.binary()), ("g", pa.binary()), ("k", pa.binary())]))

    return words.select("block", "part", "h", "g", "n").groupBy("part").applyInArrow(
        run, "block bigint, part int, types bigint, frequent array<bigint>, counts array<bigint>, "
             "i binary, c binary, g binary, k binary")


def _neighbours(tokens: DataFrame, state: DataFrame, frequent: dict[int, tuple[np.ndarray, np.ndarray]],
                items: np.ndarray, classes: int) -> DataFrame:
    """One pass over the training tokens with the classes of ``state`` (block, part, i, k) and, for the frequent
    words, of ``items``.

    Per block and part: how many cells each word has, their numbers (class that
    follows, or classes + class that precedes) and counts.  Per block, in a row
    of part -1, keys and counts of the class bigrams, then of the cells of the
    ``frequent`` words (part -> numbers in the part, item numbers)."""
    import pyarrow as pa
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("i", pa.binary()), ("k", pa.binary()),
                        ("cells", pa.binary()), ("cell", pa.binary()), ("x", pa.binary()),
                        ("key", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))])
    width = 2 * classes

    def run(text: pa.Table, words: pa.Table) -> pa.Table:
        if not text.num_rows:
            return schema.empty_table()
        words = words.sort_by("part")
        ks = _all(words["k"])
        cls = np.concatenate([[0], *ks]).astype(np.int64)
        item = np.zeros(len(cls), dtype=np.int64)
        at = 1 + np.concatenate([[0], np.cumsum([len(k) for k in ks])]).astype(np.int64)
        for p, a, i in zip(words["part"].to_pylist(), at, words["i"].to_pylist()):
            if p in frequent:
                number, own = frequent[p]
                i = np.cumsum(_unpack(i))
                j = np.minimum(np.searchsorted(i, number), len(i) - 1)
                found = i[j] == number
                item[a + j[found]] = own[found]
        cls = np.where(item > 0, items[item], cls)
        seq = _unpack(text["ids"][0].as_py())
        ends = np.flatnonzero(seq == 0)
        train = ~np.array(text["held_out"][0].as_py(), dtype=bool)
        seq = seq[np.repeat(train, np.diff(ends, prepend=-1))]
        left = np.concatenate([[0], seq[:-1]]) if len(seq) else seq
        lk, rk = cls[left], cls[seq]
        table = np.bincount(lk * classes + rk, minlength=classes * classes)
        key, x = np.unique(np.concatenate([left * width + rk, seq * width + classes + lk]), return_counts=True)
        word, cell = key // width, key % width
        f = item[word]
        t = np.flatnonzero(table)
        block = text["block"][0].as_py()
        rows = [{"block": block, "part": -1,
                 "key": np.concatenate([t, classes * classes + f[f > 0] * width + cell[f > 0]]).tolist(),
                 "n": np.concatenate([table[t], x[f > 0]]).tolist()}]
        cells = np.bincount(word, minlength=len(cls))
        to = np.searchsorted(word, at)
        for r, (p, a, b) in enumerate(zip(words["part"].to_pylist(), to[:-1], to[1:])):
            rows.append({"block": block, "part": p, "i": words["i"][r].as_py(), "k": _pack(cls[at[r]:at[r + 1]]),
                         "cells": _pack(cells[at[r]:at[r + 1]]), "cell": _pack(cell[a:b]), "x": _pack(x[a:b])})
        return pa.Table.from_pylist(rows, schema=schema)

    return tokens.groupBy("block").cogroup(
        state.select("block", "part", "i", "k").groupBy("block")).applyInArrow(
        run, "block bigint, part int, i binary, k binary, cells binary, cell binary, x binary, "
             "key array<bigint>, n array<bigint>")


def _batches(size: np.ndarray):
    """Words (places in ``size``, their numbers of cells) in runs of about ``CELLS`` cells, and how many cells each
    word of the run has: those of 1 to ``FEW`` by that number, then the others (0)."""
    for length in range(1, FEW + 1):
        w = np.flatnonzero(size == length)
        for a in range(0, len(w), CELLS // length):
            yield w[a:a + CELLS // length], length
    w = np.flatnonzero(size > FEW)
    end = np.cumsum(size[w])
    a = 0
    while a < len(w):
        b = max(a + 1, int(np.searchsorted(end, end[a] - size[w[a]] + CELLS, "right")))
        yield w[a:b], 0
        a = b


def _run_sums(x: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Sums of the rows of every run, as ``np.add.reduceat`` adds them up; ``length``: of all runs if not 0."""
    if not length:
        return np.add.reduceat(x, first, axis=0)
    x = x.reshape(-1, length, x.shape[1])
    if length == 1:
        return x[:, 0]
    rest = x[:, 1]
    for i in range(2, length):
        rest = rest + x[:, i]
    return x[:, 0] + rest


def _best_classes(word: np.ndarray, cell: np.ndarray, x: np.ndarray, cls: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class of the largest likelihood for every word, each taken out of its class and all others kept.
    Cells ascend by word; words without cells stay."""
    classes = len(table)
    out = cls.copy()
    if not len(word):
        return out
    sides = np.concatenate([table.T, table])                  # cell -> count with each class
    base = _xlogx(sides)
    small = np.concatenate([_xlogx(sides + v) - base for v in range(1, SMALL + 1)])
    totals = (table.sum(axis=1), table.sum(axis=0))
    start = np.flatnonzero(np.diff(word, prepend=-1))
    cells = np.diff(start, append=len(word))
    tokens, kind = np.unique(np.add.reduceat(np.where(cell < classes, x, 0), start).astype(float), return_inverse=True)
    costs = [_xlogx(total + tokens[:, None]) - _xlogx(total) for total in totals]
    for run, length in _batches(cells):
        n = cells[run]
        first = np.cumsum(n) - n
        r = np.arange(int(n.sum()))
        at = np.repeat(start[run] - first, n) + r
        j, v, w = cell[at], x[at], word[start[run]]
        gain = small[(np.minimum(v, SMALL) - 1) * (2 * classes) + j]
        big = np.flatnonzero(v > SMALL)
        gain[big] = _xlogx(sides[j[big]] + v[big, None]) - base[j[big]]
        own = np.repeat(cls[w], n)
        gain[r, own] = base[j, own] - _xlogx(np.maximum(sides[j, own] - v, 0))
        gain = _run_sums(gain, first, length)
        r, own, size = np.arange(len(w)), cls[w], tokens[kind[run]]
        for total, costly in zip(totals, costs):
            cost = costly[kind[run]]
            cost[r, own] = _xlogx(total[own]) - _xlogx(np.maximum(total[own] - size, 0))
            gain -= cost
        gain[:, 0] = -np.inf                                  # class 0 holds the end alone
        out[w] = np.argmax(gain, axis=1)
    return out


def _moved(counted: DataFrame, table: np.ndarray) -> DataFrame:
    """(block, part, i, k): every word in its best class."""
    import pyarrow as pa
    width = 2 * len(table)

    def run(t: pa.Table) -> pa.Table:
        numbers = [np.cumsum(i) for i in _all(t["i"])]
        i, k = _joined(numbers), _joined(_all(t["k"]))
        cls = np.zeros(int(i.max(initial=-1)) + 1, dtype=np.int64)
        cls[i] = k
        key = np.repeat(i, _joined(_all(t["cells"]))) * width + _joined(_all(t["cell"]))
        x = _joined(_all(t["x"]))
        order = np.argsort(key, kind="stable")
        key, x = key[order], x[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        x = np.add.reduceat(x, first) if len(first) else x
        key = key[first]
        cls = _best_classes(key // width, key % width, x, cls, table)
        return pa.table({"block": t["block"], "part": t["part"], "i": t["i"],
                         "k": pa.array([_pack(cls[n]) for n in numbers], pa.binary())})

    return counted.filter("part >= 0").select("block", "part", "i", "k", "cells", "cell", "x").groupBy(
        "part").applyInArrow(run, "block bigint, part int, i binary, k binary")


def _sums(counted: DataFrame, items: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class bigram counts and the frequent items' counts of the classes that follow and precede them."""
    # At most classes^2 + 2 * items * classes rows, and items is bounded by 1 / FREQUENT + 1.
    rows = (counted.filter("part < 0").select(F.explode(F.arrays_zip("key", "n")).alias("z"))
            .groupBy("z.key").agg(F.sum("z.n").alias("n"))).toPandas()
    x = np.zeros(classes * classes + 2 * items * classes)
    x[rows["key"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=float)
    side = x[classes * classes:].reshape(items, 2, classes)
    return x[:classes * classes].reshape(classes, classes), side[:, 0], side[:, 1]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def _likelihood(table: np.ndarray) -> float:
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=0)).sum() - _xlogx(table.sum(axis=1)).sum())


def _class_table(follow: np.ndarray, cls: np.ndarray, classes: int) -> np.ndarray:
    table = np.zeros((classes, classes))
    np.add.at(table, cls, follow)
    return table


def _exchange(follow: np.ndarray, precede: np.ndarray, cls: np.ndarray, classes: int,
              table: np.ndarray | None = None) -> np.ndarray:
    """One sweep: every item in turn, frequent ones first, goes to the class of the largest likelihood.
    Class 0 holds the text end alone.  ``table``: class bigram counts, if the items are not all words."""
    table = _class_table(follow, cls, classes) if table is None else table.copy()
    rows, cols = table.sum(axis=1), table.sum(axis=0)
    cls = cls.copy()
    n = follow.sum(axis=1)
    for i in np.argsort(-n, kind="stable"):
        if i == 0 or n[i] == 0:
            continue
        a, f, p = cls[i], follow[i], precede[i]
        table[a] -= f
        table[:, a] -= p
        np.maximum(table, 0, out=table)
        rows[a] -= n[i]
        cols[a] -= n[i]
        nz, pz = np.flatnonzero(f), np.flatnonzero(p)
        right, left = table[:, nz], table[pz]
        gain = (_xlogx(right + f[nz]) - _xlogx(right)).sum(axis=1) + (_xlogx(left + p[pz, None]) - _xlogx(left)).sum(axis=0)
        r, c = np.maximum(rows, 0), np.maximum(cols, 0)
        gain -= _xlogx(r + n[i]) - _xlogx(r) + _xlogx(c + n[i]) - _xlogx(c)
        gain[0] = -np.inf
        b = int(np.argmax(gain))
        cls[i] = b
        table[b] += f
        table[:, b] += p
        rows[b] += n[i]
        cols[b] += n[i]
    return cls


def cluster_words(tokens: DataFrame, state: DataFrame, frequent: dict[int, tuple[np.ndarray, np.ndarray]],
                  first: np.ndarray, classes: int = CLASSES,
                  sweeps: int = SWEEPS) -> tuple[DataFrame, str, np.ndarray, list]:
    """(rows of ``_neighbours`` with the classes found, their folder, class bigram counts, likelihoods) by exchange
    clustering.

    ``first``: the first classes of the frequent items, item 0 being the end.  They differ, as far as there are
    classes, and stay for the first sweep: the other words are spread evenly then, so they tell frequent words
    apart only after it.  The shared folder holds the counts of two sweeps at most; the caller drops the folder
    returned."""
    spark, cls = tokens.sparkSession, first
    # Dealt by block once: the sweeps then shuffle only classes and counts.
    tokens = tokens.select("block", "ids", "held_out").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "block").persist(StorageLevel.DISK_ONLY)
    best, at = stored_at(_neighbours(tokens, state, frequent, cls, classes))
    table, follow, precede = _sums(best, len(cls), classes)
    likelihoods = [_likelihood(table)]
    for sweep in range(sweeps):
        if sweep:
            cls = _exchange(follow, precede, cls, classes, table)
        # Stored, so that no sweep hangs on the sweeps before it: their shuffles end with the write.
        counted, to = stored_at(_neighbours(tokens, _moved(best, table), frequent, cls, classes))
        t, f, p = _sums(counted, len(cls), classes)
        got = _likelihood(t)
        gain = got - likelihoods[-1]
        if gain <= 0:
            dropped(spark, to)
            if sweep:
                break
            continue
        dropped(spark, at)
        best, at, table, follow, precede = counted, to, t, f, p
        likelihoods.append(got)
        if sweep and gain < 1e-4 * abs(got):
            break
    tokens.unpersist()
    return best, at, table, likelihoods


def _shape(coded: DataFrame, classes: int) -> np.ndarray:
    """Per class: tokens, words, words met once, words met twice; then, per suffix group and class, words."""
    import pyarrow as pa

    def run(t: pa.Table) -> pa.Table:
        i, first = np.unique(_joined([np.cumsum(x) for x in _all(t["i"])]), return_index=True)
        c, g, k = (_joined(_all(t[name]))[first] for name in "cgk")
        c, g, k = c[c > 0], g[c > 0], k[c > 0]
        key = np.concatenate([k, classes + k, 2 * classes + k[c == 1], 3 * classes + k[c == 2], (4 + g) * classes + k])
        n = np.concatenate([c, np.ones(len(key) - len(c), dtype=np.int64)])
        key, back = np.unique(key, return_inverse=True)
        return pa.table({"key": key, "n": np.bincount(back, weights=n, minlength=len(key)).astype(np.int64)})

    # At most (4 + SUFFIX_GROUPS) * classes rows.
    rows = coded.groupBy("part").applyInArrow(run, "key bigint, n bigint").groupBy("key").agg(
        F.sum("n").alias("n")).toPandas()
    x = np.zeros((4 + SUFFIX_GROUPS) * classes)
    x[rows["key"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=float)
    return x.reshape(-1, classes)


def class_lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                    classes: int = CLASSES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity).

    Learns from the rows where ``held_out`` is false and scores every row.
    Tokens: words in lower case (A-Z), then one end.  ``score`` is the log10
    probability of the whole token sequence, ``perplexity`` its inverse
    geometric mean.  Null and empty texts are one end token.  Null ids and
    repeated rows are kept.  Without training rows every token is unknown:
    base_score 0.
    """
    import pyarrow as pa

    spark, kind = docs.sparkSession, dict(docs.dtypes)[id_col]
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    part_bits = max(0, math.ceil(math.log2(max(1, input_bytes(slim, "text") / PART_BYTES))))
    blocks, blocks_at = stored_at(_text_blocks(slim, kind, part_bits))
    # Copied, so that the blocks' words, which only the vocabulary reads, can be dropped before the search.
    tokens, _ = stored_at(blocks.filter("part < 0").select("block", "doc_id", "held_out", "tokens", "ids"))
    size = tokens.agg(F.sum("tokens").alias("n"),
                      F.sum(F.size(F.filter("held_out", lambda x: ~x))).alias("texts")).first()
    n_tokens, n_train = int(size["n"] or 0), int(size["texts"] or 0)

    with shuffles_freed(spark):
        vocabulary, vocabulary_at = stored_at(
            _vocabulary(blocks.filter("part >= 0"), max(1, math.ceil(n_tokens * FREQUENT)), classes))
    dropped(spark, blocks_at)
    parts = vocabulary.filter("block < 0").select("part", "types", "frequent", "counts").orderBy("part").collect()
    n_types = sum(r["types"] for r in parts) + (n_train > 0)
    frequent, counts = {}, []                             # at most 1 / FREQUENT words
    for r in parts:
        if r["frequent"]:
            frequent[r["part"]] = np.array(r["frequent"]), 1 + len(counts) + np.arange(len(r["frequent"]))
            counts += r["counts"]
    first = np.zeros(1 + len(counts), dtype=np.int64)
    first[1 + np.argsort(-np.array(counts, dtype=np.int64), kind="stable")] = 1 + np.arange(len(counts)) % (classes - 1)
    words = vocabulary.filter("block >= 0")
    with shuffles_freed(spark):
        best, best_at, table, _ = cluster_words(tokens, words, frequent, first, classes)
        coded, _ = stored_at(words.select("block", "part", "i", "c", "g").join(
            best.filter("part >= 0").select("block", "part", "k"), ["block", "part"]))
        dropped(spark, best_at)
        dropped(spark, vocabulary_at)
        shape = _shape(coded, classes)
    groups = np.where(shape[4:].any(axis=1), shape[4:].argmax(axis=1), max(1, int(shape[1].argmax())))
    total, discount, unknown = np.ones(classes), np.full(classes, 0.5), np.ones(classes)
    for k in np.flatnonzero(shape[0]):
        n, v, n1, n2 = shape[:4, k]
        total[k] = n
        if n1 and n2:
            discount[k] = min(0.9, max(0.1, n1 / (n1 + 2.0 * n2)))
        unknown[k] = discount[k] * v / n
    share = (table.sum(axis=0) + 1.0) / (table.sum() + classes)
    step = np.log10((table + TRANSITION_PRIOR * share) / (table.sum(axis=1, keepdims=True) + TRANSITION_PRIOR))
    log_total, log_unknown = np.log10(total), np.log10(unknown)
    base_total = math.log10(n_tokens + n_types + 1)

    def score(text: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by("part")
        c, g, k = (_joined(_all(words[name])) for name in "cgk")
        k = np.where(c > 0, k, groups[g])
        seq = _joined(_all(text["ids"]))
        c, k = np.append(n_train, c)[seq], np.append(0, k)[seq]
        end = np.flatnonzero(seq == 0) + 1
        start = np.concatenate([[0], end[:-1]]).astype(np.int64) if len(end) else end
        prev = np.concatenate([[0], k[:-1]]) if len(k) else k
        word = np.where(c > 0, np.log10(np.maximum(c - discount[k], 1e-9)) - log_total[k], log_unknown[k])
        word[k == 0] = 0.0                            # class 0 holds the end alone
        s, b, known = (np.add.reduceat(x, start) if len(start) else x for x in (
            step[prev, k] + word, np.log10(c + 1.0) - base_total, (c > 0).astype(np.int64)))
        n = end - start
        return pa.table({
            "doc_id": text["doc_id"].combine_chunks().flatten(),
            "held_out": text["held_out"].combine_chunks().flatten(), "n_tokens": pa.array(n.astype(np.int64)),
            "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(n), n_tokens, dtype=np.int64)),
            "base_score": pa.array(b), "score": pa.array(s),
            "perplexity": pa.array(10.0 ** np.minimum(-s / np.maximum(n, 1), 300.0))})

    return tokens.select("block", "doc_id", "held_out", "ids").groupBy("block").cogroup(
        coded.select("block", "part", "c", "g", "k").groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
               "base_score double, score double, perplexity double")
