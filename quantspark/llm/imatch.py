"""I-Match document fingerprints over randomised lexicons.

Terms are kept if their document frequency lies in a band relative to the
corpus: at least ``LOW`` of the documents (below it: typos, names) and at most
``HIGH`` (above it: function words, boilerplate).  The low end also bounds the
lexicon: documents hold D distinct terms on average, so at most D / LOW terms
can reach it, however large the corpus; it is broadcast behind that bound.
``SUBSETS`` random subsets of the lexicon, of several sizes, each give one
signature: the hash of the sorted distinct terms the text has in it.  The
likeness of two fingerprints is the share of equal signatures among the
subsets that hold a term of either text; sparse subsets make it follow the
overlap of the term sets.

For neighbours and edited texts the documents are dealt once into blocks of
consecutive ids, with each block's successor row as context.  Built-in
expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm.common import input_bytes, stored

LOW, HIGH = 2.0 ** -11, 2.0 ** -3
MIN_DOCUMENTS = 2
# Share of the lexicon in the subsets of each level, 2^-r; every level has PER_LEVEL subsets.
LEVELS, PER_LEVEL = (2, 4, 6, 7, 8, 9, 10, 12), 8
RATES = tuple(r for r in LEVELS for _ in range(PER_LEVEL))
SUBSETS = len(RATES)
DENSE = 6                             # a level with more subsets in use is too dense to show overlap
BLOCK_BYTES, MAX_BLOCKS = 4 << 20, 1 << 16
GROUPS_IN_MEMORY = 20_000
SPLIT = r"[\x20\x09-\x0D\p{Punct}]+"


def terms(text: Column) -> Column:
    """Distinct lower-case terms between white space and ASCII punctuation."""
    return F.array_distinct(F.filter(F.split(F.lower(text), SPLIT), lambda w: w != ""))


def lexicon(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(h, pairs): hash of every term inside the band; (subset, hash) for every subset it belongs to."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    counts = stored(docs.select(F.explode(terms(text)).alias("w")).groupBy(F.xxhash64("w").alias("h"))
                    .agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= MIN_DOCUMENTS))
    n = docs.count()
    pairs = F.array_compact(F.array(*[F.when(F.pmod(F.xxhash64("h", F.lit(i)), F.lit(1 << r)) == 0,
                                             F.struct(F.lit(i).alias("s"), F.col("h").alias("h")))
                                      for i, r in enumerate(RATES)]))
    # A corpus of a few documents has no term below HIGH: the band is then all repeated terms.
    return counts.filter((F.col("df") >= LOW * n) & (F.col("df") <= max(HIGH * n, MIN_DOCUMENTS))).select(
        "h", pairs.alias("pairs"))


def _starts(pairs: Column) -> Column:
    """Places (from 1) in sorted (subset, term) pairs at which a subset's run begins."""
    return F.when(F.size(pairs) > 0, F.filter(
        F.sequence(F.lit(1), F.size(pairs)),
        lambda i: (i == 1) | (F.get(pairs, i - 1)["s"] != F.get(pairs, i - 2)["s"]))).otherwise(F.array().cast("array<int>"))


def _subset_hashes(pairs: Column, starts: Column) -> Column:
    """Map from subset to the hash of its run of sorted (subset, term) pairs, without the empty subsets."""
    def run(at: Column, k: Column) -> Column:
        end = F.coalesce(F.get(starts, k + 1), F.size(pairs) + 1)
        return F.aggregate(F.slice(pairs, at, end - at), F.lit(None).cast("bigint"), lambda h, p: F.xxhash64(h, p["h"]))

    return F.map_from_arrays(F.transform(starts, lambda at: F.get(pairs, at - 1)["s"]), F.transform(starts, run))


def _signatures(by_subset: Column) -> Column:
    """One signature per subset; an empty string where the text has no term of it."""
    return F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda i: F.coalesce(
        F.right(F.lpad(F.hex(F.element_at(by_subset, i)), 16, "0"), F.lit(8)), F.lit("")))


def _levels(x: Column, y: Column) -> Column:
    """Per level, how many of its subsets hold a term of either text and how many signatures are equal."""
    def level(i: Column) -> Column:
        a, b = F.slice(x, i * PER_LEVEL + 1, F.lit(PER_LEVEL)), F.slice(y, i * PER_LEVEL + 1, F.lit(PER_LEVEL))
        used = F.filter(F.zip_with(a, b, lambda p, q: (p != "") | (q != "")), lambda hit: hit)
        same = F.filter(F.zip_with(a, b, lambda p, q: (p != "") & (p == q)), lambda hit: hit)
        return F.struct(F.size(used).alias("used"), F.size(same).alias("same"))
    return F.transform(F.sequence(F.lit(0), F.lit(len(LEVELS) - 1)), level)


def _share(levels: Column, x: Column, y: Column) -> Column:
    """Likeness of two fingerprints (as arrays) from their level counts."""
    some = F.filter(levels, lambda p: p["used"] > 0)
    sparse = F.filter(some, lambda p: p["used"] <= DENSE)
    chosen = F.when(F.size(sparse) > 0, sparse).otherwise(F.slice(some, -1, 1))
    used = F.aggregate(chosen, F.lit(0), lambda t, p: t + p["used"])
    same = F.aggregate(chosen, F.lit(0), lambda t, p: t + p["same"])
    whole = (F.element_at(x, -1) == F.element_at(y, -1)).cast("double")
    return F.when(x == y, F.lit(1.0)).when(F.size(some) > 0, same / used).otherwise(whole).cast("double")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures among the subsets that hold a term of either text, over the levels of
    which at most ``DENSE`` subsets do (the sparsest level, where all are denser).  With few terms per
    subset this follows the overlap of the term sets; equal fingerprints give 1.  Two texts without a
    term in any subset are alike if the hashes of all their terms (the last element) are equal."""
    x, y = F.split(a, ","), F.split(b, ",")
    return _share(_levels(x, y), x, y)


def _block_of(key: Column, bounds: list) -> Column:
    """Number of the last bound that is not above ``key``: a binary search over a literal array."""
    arr = F.array(*[F.lit(b) for b in bounds])
    steps = [1 << i for i in reversed(range(max(1, len(bounds).bit_length())))]
    last = F.lit(len(bounds) - 1)
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when((at + s <= last) & (F.get(arr, at + s) <= key), at + s).otherwise(at))


def _blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(blk, ctx, doc_id, text): consecutive ids per block, null ids in the last one.  ``ctx`` marks rows
    that only follow: 1 the next block's first rows, 2 the first rows of all, after the last block."""
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    n = min(MAX_BLOCKS, max(1, -(-input_bytes(slim, "text") // BLOCK_BYTES)))
    cuts = slim.agg(F.min("doc_id").alias("lo"), F.percentile_approx(
        "doc_id", F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5)),
        F.lit(max(10_000, 20 * n))).alias("cuts")).first()
    if cuts["lo"] is None:                            # no row, or no id at all: one block, any order
        bounds = [0]
    else:
        bounds = sorted({cuts["lo"], *(cuts["cuts"] if n > 1 else [])})
    last = len(bounds) - 1
    own = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(_block_of(F.col("doc_id"), bounds))
    home = F.struct(own.cast("int").alias("blk"), F.lit(0).alias("ctx"))
    start = F.array_contains(F.array(*[F.lit(b) for b in bounds[1:]]), F.col("doc_id")) if last else F.lit(False)
    wrap = F.col("doc_id") == F.lit(bounds[0]) if cuts["lo"] is not None else F.lit(True)
    copies = (F.when(wrap, F.array(home, F.struct(F.lit(last).alias("blk"), F.lit(2).alias("ctx"))))
              .when(start, F.array(home, F.struct((own - 1).cast("int").alias("blk"), F.lit(1).alias("ctx"))))
              .otherwise(F.array(home)))
    return slim.select(F.explode(copies).alias("c"), "doc_id", "text").select("c.blk", "c.ctx", "doc_id", "text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text replaces the last floor(n_chars / 2) code points by the
    first as many (or all) of the next row's text, by ascending id, after the
    last the first.  Ids are numbers; rows with a null id come last, rows of
    one id in the order of their texts' hashes.  Null texts are empty; a text
    without lexicon terms has the hash of all its terms alone.  One row is its
    own successor; an empty table gives an empty result.
    """
    # The rows of a text follow each other; keep this many texts of a task in the aggregation's hash map
    # before it sorts.
    docs.sparkSession.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(GROUPS_IN_MEMORY))
    lex = F.broadcast(lexicon(docs, text_col)
                      .unionByName(docs.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("h"),
                                                                     F.array().cast("array<struct<s:int,h:bigint>>").alias("pairs"))))
    order = Window.partitionBy("blk").orderBy("ctx", F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"))
    n = F.length("text")
    rows = (_blocks(docs, id_col, text_col)
            .select("blk", "ctx", "doc_id", "text", F.lead("text", 1, "").over(order).alias("nxt"),
                    F.row_number().over(order).alias("pos"))
            .withColumn("n_chars", n.cast("bigint")).withColumn("half", F.floor(n / 2).cast("int"))
            .withColumn("edited", F.concat(F.expr("substring(text, 1, n_chars - half)"), F.expr("substring(nxt, 1, half)")))
            .withColumn("sha", F.sha2(F.col("edited").cast("binary"), 256)))
    # Hash 0 stands for "no more terms": it is in the lexicon and in no subset, so that every text keeps a row.
    side = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")),
                             F.struct(F.lit(1).alias("side"), F.col("edited").alias("t"))))
    sides = rows.select("blk", "pos", "ctx", "doc_id", "n_chars", "sha", side.alias("s")).select(
        "blk", "pos", "ctx", "doc_id", "n_chars", "sha", "s.side", terms(F.col("s.t")).alias("w"))
    sides = sides.withColumn("whole", F.hex(F.xxhash64(F.sort_array("w"))))     # once per text, below the explode
    words = sides.select("blk", "pos", "ctx", "doc_id", "n_chars", "sha", "side", "whole",
                         F.explode(F.concat(F.array(F.lit(None).cast("string")), F.col("w"))).alias("w"))
    h = F.when(F.col("w").isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64("w"))
    # What describes a text stands in its row without a term alone: the aggregation does not copy it for every term.
    own = F.when(F.col("w").isNull(), F.struct("ctx", "doc_id", "n_chars", "sha", "whole"))
    marked = words.select("blk", "pos", "side", own.alias("own"), h.alias("h")).join(lex, "h")
    prints = (marked.groupBy("blk", "pos", "side").agg(
        F.collect_list("own").alias("own"), F.collect_list("pairs").alias("found"))
        .select("blk", "pos", "side", F.col("own")[0].alias("own"), "found").select("blk", "pos", "side", "own.*", "found")
        # exploding one value keeps it a column: it is not evaluated again by what reads it, and sorted by compiled code
        .withColumn("pairs", F.explode(F.array(F.flatten("found")))).drop("found")
        .withColumn("pairs", F.explode(F.array(F.sort_array("pairs"))))
        .withColumn("starts", F.explode(F.array(_starts(F.col("pairs")))))
        .withColumn("by_subset", F.explode(F.array(_subset_hashes(F.col("pairs"), F.col("starts")))))
        .withColumn("fp", F.array_join(F.concat(_signatures(F.col("by_subset")), F.array("whole")), ",")))
    per_doc = prints.groupBy("blk", "pos").agg(
        F.first("ctx").alias("ctx"), F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"),
        F.first("sha").alias("edited_sha256"), F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fingerprint"),
        F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("edited_fingerprint"))
    follow = F.lead("fingerprint").over(Window.partitionBy("blk").orderBy("pos"))
    # As in ``likeness``, with the parts kept as columns (exploding one value), so that none is evaluated twice.
    prints = F.struct(*[F.split(c, ",").alias(n) for c, n in (
        ("fingerprint", "x"), ("edited_fingerprint", "y"), ("next_print", "z"))])
    levels = F.struct(_levels(F.col("p.x"), F.col("p.y")).alias("xy"), _levels(F.col("p.x"), F.col("p.z")).alias("xz"))
    return (per_doc.withColumn("next_print", follow).filter("ctx = 0")
            .withColumn("p", F.explode(F.array(prints))).withColumn("l", F.explode(F.array(levels)))
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    _share(F.col("l.xy"), F.col("p.x"), F.col("p.y")).alias("near_edited"),
                    _share(F.col("l.xz"), F.col("p.x"), F.col("p.z")).alias("near_next")))
