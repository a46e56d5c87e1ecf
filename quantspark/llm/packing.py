"""Best-fit packing of tokenised documents into fixed-length sequences by linear grouping.

1. Documents are tokenised (one end id appended); only documents longer than
   the capacity are cut, with the short piece first.
2. One aggregation gives the exact length histogram: at most ``capacity``
   rows whatever the input size, so the plan is made on the driver from
   counts alone.
3. Linear grouping: pieces above ``capacity / small_fraction`` form
   ``n_groups`` groups of equal cardinality, each rounded up to its longest
   length; the few-size cutting-stock problem is solved by column generation
   (configurations priced by a knapsack) and rounded down.
4. Actual lengths replace the rounded ones, group by group in descending
   order, as run-length patterns; the leftovers and all small pieces are then
   best-fitted into the true gaps, longest first, again on counts.
5. Every piece learns its rank among the pieces of its length (a range sort
   with block offsets, no single task) and looks up its slot in the plan.

The plan's size depends on the capacity and the group count, never on the
number of documents.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from bisect import bisect_left, insort
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.llm import textvec as tv
from quantspark.llm.common import stored
from quantspark.operators.ordered import POS, with_position

CAPACITY = 1024
N_GROUPS = 96
SMALL_FRACTION = 8
MEMO_ENTRIES = 800_000

# ---------------------------------------------------------------- tokens

_GRAPH = np.zeros(256, dtype=bool)
_GRAPH[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = _GRAPH & ~_LETTER
_PUNCT[48:58] = False
_PUNCT[ord("'")] = False
_TWO = np.zeros(256, dtype=bool)
_TWO[0xC3:0xE0] = True   # lead bytes of two-byte letters and marks that are never white space


def _chunk_starts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Byte positions at which the tokenizer's own splitting rule always starts a new unit:
    before a lone space or line feed, after a lone line feed, and between a Latin letter and
    punctuation.  Both neighbours must be plainly not white space; anything else is not cut."""
    n = len(buf)
    solid_end = _GRAPH[buf]                       # this byte ends a character that is not white space
    solid_end[1:] |= (buf[1:] >= 0x80) & (buf[1:] < 0xC0) & _TWO[buf[:-1]]
    solid_start = _GRAPH[buf] | _TWO[buf]
    head = np.zeros(n, dtype=bool)
    head[offs[:-1][offs[:-1] < n]] = True
    cut = head.copy()
    if n > 2:
        gap = (buf[1:-1] == 32) | (buf[1:-1] == 10)
        lone = gap & solid_end[:-2] & solid_start[2:] & ~head[1:-1] & ~head[2:]
        cut[1:-1] |= lone
        cut[2:] |= lone & (buf[1:-1] == 10)
        cut[1:] |= _LETTER[buf[:-1]] & _PUNCT[buf[1:]]
    return np.flatnonzero(cut)


class _Memo:
    """Token ids of the distinct text units this worker process has met (a memo: dropped when full).

    Keys are 64-bit span hashes in an open-addressing table, so a lookup of millions of units is a
    few vectorised probes.
    """

    BITS = 21

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.whole = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100.
        own = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = iter(range(256, 512))
        self.alphabet = {b: chr(b if b in own else next(rest)) for b in range(256)} | {10: "\n"}
        self.alphabet = "".join(self.alphabet[b] for b in range(256))
        self.clear()

    def clear(self):
        self.slot = np.zeros(1 << self.BITS, dtype=np.uint64)    # 0: free
        self.entry = np.zeros(1 << self.BITS, dtype=np.int32)
        self.at = np.zeros(0, dtype=np.int32)
        self.size = np.zeros(0, dtype=np.int32)
        self.ids = np.zeros(0, dtype=np.uint32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Entry number of each key, -1 where unknown."""
        mask = np.uint64((1 << self.BITS) - 1)
        place = (keys & mask).astype(np.int64)
        out = np.where(self.slot[place] == keys, self.entry[place], -1)
        todo = np.flatnonzero((out < 0) & (self.slot[place] != 0))
        while len(todo):
            place[todo] = (place[todo] + 1) & int(mask)
            got = self.slot[place[todo]]
            hit = got == keys[todo]
            out[todo[hit]] = self.entry[place[todo[hit]]]
            todo = todo[~hit & (got != 0)]
        return out

    def add(self, keys: np.ndarray, texts: list[str]) -> None:
        """Encode new, distinct units.  A unit of letters after at most one space is one word of the
        splitting rule, so the merge model takes it directly; others go the whole way."""
        words, other = [], []
        for i, t in enumerate(texts):
            (words if (t[1:] if t[0] == " " else t).isalpha() else other).append(i)
        parts = [None] * len(texts)
        merge = self.tokenizer.model.tokenize
        mapped = "\n".join([texts[i] for i in words]).encode().decode("latin1").translate(self.alphabet)
        for i, w in zip(words, mapped.split("\n")):
            parts[i] = [k.id for k in merge(w)]
        for i, got in zip(other, self.tokenizer.encode_batch([texts[i] for i in other], add_special_tokens=False)):
            parts[i] = got.ids
        size = np.fromiter(map(len, parts), dtype=np.int32, count=len(parts))
        flat = np.fromiter(chain.from_iterable(parts), dtype=np.uint32, count=int(size.sum()))
        old = len(self.at)
        self.at = np.concatenate([self.at, (len(self.ids) + np.cumsum(size) - size).astype(np.int32)])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, flat])
        mask = np.int64((1 << self.BITS) - 1)
        place, todo = (keys & np.uint64(mask)).astype(np.int64), np.arange(len(keys))
        while len(todo):                               # the last writer of a free place owns it
            free = todo[self.slot[place[todo]] == 0]
            self.slot[place[free]] = keys[free]
            won = self.slot[place[todo]] == keys[todo]
            self.entry[place[todo[won]]] = old + todo[won]
            todo = todo[~won]
            place[todo] = (place[todo] + 1) & mask


def _memo(path: str) -> _Memo:
    """One memo per worker process and tokenizer, kept from task to task."""
    home = sys.modules.setdefault("quantspark_llm_memo", types.ModuleType("quantspark_llm_memo"))
    if getattr(home, "path", None) != path:
        home.path, home.memo = path, _Memo(path)
    return home.memo


def token_ids(buf: np.ndarray, offs: np.ndarray, memo: _Memo) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows one after another, tokens per row)."""
    rows = len(offs) - 1
    if not len(buf):
        return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
    raw = buf.tobytes()
    if any(w in raw for w in memo.whole):              # rows with an added token's own text: as a whole
        coded = [memo.tokenizer.encode(raw[a:b].decode(), add_special_tokens=False).ids
                 for a, b in zip(offs[:-1], offs[1:])]
        return (np.array([i for c in coded for i in c], dtype=np.uint32),
                np.array([len(c) for c in coded], dtype=np.int64))
    starts = _chunk_starts(buf, offs)
    ends = np.append(starts[1:], len(buf))
    keys = tv.span_hashes(buf, starts, ends, lower=False) | np.uint64(1 << 63)
    at = memo.find(keys)
    lost = np.flatnonzero(at < 0)
    if len(lost):
        if len(memo.at) > MEMO_ENTRIES:
            memo.clear()
            lost = np.arange(len(keys))
        new, first = np.unique(keys[lost], return_index=True)
        first = lost[first]
        memo.add(new, [raw[s:e].decode() for s, e in zip(starts[first], ends[first])])
        at[lost] = memo.find(keys[lost])
    size = memo.size[at]
    stop = np.cumsum(size, dtype=np.int64)
    ids = memo.ids[np.repeat(memo.at[at] - (stop - size), size) + np.arange(int(stop[-1]))]
    edge = np.searchsorted(starts, offs)               # first unit of each row
    stop = np.concatenate([[0], stop])[edge]
    return ids, np.diff(stop)


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     end_id: int = 2, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids]) of every row.

    A null text counts as empty (one piece: the end id).  Documents longer
    than ``capacity`` are cut into pieces of ``capacity`` tokens; the first
    piece takes the remainder.  Null ids and repeated rows are kept as they are.
    """
    import pyarrow as pa

    def run(batches):
        memo = _memo(tokenizer_path)
        for batch in batches:
            buf, offs = tv.arrow_text(batch.column(1))
            for a, b in tv.slices(offs, 2 << 20):
                ids, counts = token_ids(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a], memo)
                stop = np.cumsum(counts)
                out = {k: [] for k in ("row", "piece", "start", "length", "crc", "ids")}
                for r in range(b - a):
                    own = np.append(ids[stop[r] - counts[r]:stop[r]], np.uint32(end_id)).astype("<u4")
                    lo, k = 0, 0
                    hi = len(own) - capacity * (-(-len(own) // capacity) - 1)
                    while lo < len(own):
                        out["row"].append(a + r)
                        out["piece"].append(k)
                        out["start"].append(lo)
                        out["length"].append(hi - lo)
                        out["crc"].append(zlib.crc32(own[lo:hi].tobytes()))
                        if with_ids:
                            out["ids"].append(own[lo:hi].tolist())
                        lo, hi, k = hi, hi + capacity, k + 1
                cols = [batch.column(0).take(pa.array(out["row"], pa.int64())), pa.array(out["piece"], pa.int32())]
                cols += [pa.array(out[c], pa.int64()) for c in ("start", "length", "crc")]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(out["ids"], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(tv.released(run), schema + (", ids array<bigint>" if with_ids else "")))

# ---------------------------------------------------------------- plan


def _configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Column generation for min sum(x), A x >= demand; returns (configuration, amount)."""
    k = len(sizes)
    cols = np.diag(capacity // sizes).astype(float)
    cost = np.ones(k)
    inverse = np.linalg.inv(cols)
    x = inverse @ demand
    for _ in range(40 * k):
        dual = cost @ inverse
        short = int(np.argmin(dual))
        if dual[short] < -1e-9:                      # give up some surplus of this size
            enter, price = np.zeros(k), 0.0
            enter[short] = -1.0
        else:
            enter = _best_configuration(sizes, dual, capacity)
            price = 1.0
            if enter @ dual <= 1.0 + 1e-7:
                break
        step = inverse @ enter
        ok = step > 1e-9
        if not ok.any():
            break
        ratio = np.full(k, np.inf)
        ratio[ok] = np.maximum(x[ok], 0) / step[ok]
        out = int(np.argmin(ratio))
        cols[:, out], cost[out] = enter, price
        try:
            inverse = np.linalg.inv(cols)
        except np.linalg.LinAlgError:
            break
        x = inverse @ demand
    return [(cols[:, i].astype(int), float(x[i])) for i in range(k) if cost[i] > 0 and x[i] >= 1]


def _best_configuration(sizes: np.ndarray, value: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack by capacity: the configuration of largest total value."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    use = np.flatnonzero(value > 1e-12)
    # Few items fit one bin, so that many rounds of a vectorised relaxation reach the optimum.
    for _ in range(int(capacity // sizes[use].min()) if len(use) else 0):
        changed = False
        base = best.copy()
        for i in use:
            s = int(sizes[i])
            cand = base[:capacity + 1 - s] + value[i]
            better = cand > best[s:] + 1e-12
            if better.any():
                best[s:][better] = cand[better]
                pick[s:][better] = i
                changed = True
        if not changed:
            break
    out, room = np.zeros(len(sizes)), int(np.argmax(best))
    while room > 0 and pick[room] >= 0:
        out[pick[room]] += 1
        room -= int(sizes[pick[room]])
    return out


class _Bins:
    """Counts of bins by free room; a bin class is the tuple of lengths in it."""

    def __init__(self, capacity: int):
        self.capacity, self.rooms, self.by_room = capacity, [], {}

    def put(self, lengths: tuple[int, ...], count: int) -> None:
        room = self.capacity - sum(lengths)
        if room not in self.by_room:
            self.by_room[room] = []
            insort(self.rooms, room)
        self.by_room[room].append([lengths, count])

    def best_fit(self, length: int, count: int) -> None:
        while count:
            i = bisect_left(self.rooms, length)
            if i == len(self.rooms):
                per = self.capacity // length
                if count >= per:
                    self.put((length,) * per, count // per)
                if count % per:
                    self.put((length,) * (count % per), 1)
                return
            room = self.rooms[i]
            entry = self.by_room[room][-1]
            take = min(entry[1], count)
            entry[1] -= take
            if not entry[1]:
                self.by_room[room].pop()
                if not self.by_room[room]:
                    del self.by_room[room]
                    self.rooms.pop(i)
            self.put(entry[0] + (length,), take)
            count -= take


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY, n_groups: int = N_GROUPS,
                   small_fraction: int = SMALL_FRACTION) -> list[tuple[tuple[int, ...], int]]:
    """Bin classes (lengths, number of bins) that hold exactly the given numbers of pieces."""
    bins = _Bins(capacity)
    rest = dict(histogram)
    if rest.get(capacity):
        bins.put((capacity,), rest.pop(capacity))
    large = [(ln, rest[ln]) for ln in sorted(rest, reverse=True) if ln > capacity // small_fraction and rest[ln]]
    total = sum(c for _, c in large)
    if total:
        quota = max(1, -(-total // n_groups))
        groups, room = [], 0                          # groups of (length, count) runs, longest first
        for length, count in large:
            while count:
                if room == 0:
                    groups.append([])
                    room = quota
                take = min(room, count)
                groups[-1].append([length, take])
                room -= take
                count -= take
        merged = {}                                   # groups of one rounded size are one size
        for g in groups:
            merged.setdefault(g[0][0], []).extend(g)
        sizes = np.array(list(merged))
        queues = list(merged.values())
        demand = np.array([sum(c for _, c in q) for q in queues], dtype=float)
        for config, amount in sorted(_configurations(sizes, demand, capacity), key=lambda p: -p[1]):
            slots = [g for g in range(len(sizes)) for _ in range(config[g])]
            need = np.bincount(slots, minlength=len(sizes))
            left = [sum(c for _, c in q) for q in queues]
            amount = min([int(amount + 1e-9), *(left[g] // need[g] for g in set(slots))])
            if amount <= 0:
                continue
            runs = []
            for g in slots:                           # the next ``amount`` actual lengths of the group
                run, want = [], amount
                while want:
                    head = queues[g][0]
                    take = min(head[1], want)
                    run.append([head[0], take])
                    head[1] -= take
                    want -= take
                    if not head[1]:
                        queues[g].pop(0)
                runs.append(run)
            while runs[0]:
                m = min(r[0][1] for r in runs)
                bins.put(tuple(r[0][0] for r in runs), m)
                for r in runs:
                    r[0][1] -= m
                    if not r[0][1]:
                        r.pop(0)
        for length, _ in large:
            del rest[length]
        for q in queues:
            for length, count in q:
                rest[length] = rest.get(length, 0) + count
    for length in sorted(rest, reverse=True):
        bins.best_fit(length, rest[length])
    return [(lengths, count) for room in bins.rooms for lengths, count in bins.by_room[room]]


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY, n_groups: int = N_GROUPS,
                     small_fraction: int = SMALL_FRACTION) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, piece, start, length, ids_crc32).

    ``pieces`` must be cheap to read more than once (a stored table).  Every
    row gets a place; the rows of a sequence fill it without gaps from 0.
    An empty table gives an empty result.  Rows that are equal in all
    ordering columns are interchangeable.
    """
    counts = {int(r["length"]): int(r["n"]) for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    base = np.zeros(capacity + 2, dtype=np.int64)
    for length, n in counts.items():
        base[length + 1] = n
    base = np.cumsum(base)                            # rows shorter than each length
    slots, sequence = [], 0
    placed: dict[int, int] = {}
    for lengths, count in plan_sequences(counts, capacity, n_groups, small_fraction):
        offset = 0
        for length in lengths:
            slots.append((int(base[length]) + placed.get(length, 0), sequence, offset))
            placed[length] = placed.get(length, 0) + count
            offset += length
        sequence += count
    slots = np.array(sorted(slots), dtype=np.int64).reshape(-1, 3)

    import pyarrow as pa

    def run(batches):
        for batch in batches:
            pos = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(slots[:, 0], pos, "right") - 1
            cols = batch.columns[:-1] + [pa.array(slots[at, 1] + pos - slots[at, 0]), pa.array(slots[at, 2])]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id bigint, offset bigint"
    order = ["length", "doc_id", "piece", "ids_crc32"]
    placed_rows = with_position(pieces, order)
    return placed_rows.select(*pieces.columns, POS).mapInArrow(tv.released(run), schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   end_id: int = 2, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack every row of ``docs``; see the module text for the method."""
    pieces = stored(tokenized_pieces(docs, tokenizer_path, id_col, text_col, end_id, capacity, with_ids))
    return assign_sequences(pieces, capacity)


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token sequences of pieces packed ``with_ids`` (at most one capacity each)."""
    return (packed.groupBy("sequence_id")
            .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))),
                                       lambda s: s["ids"])).alias("ids")))
