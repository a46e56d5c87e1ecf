"""Mixing sources to target weights with hash-random order and distributed prefix sums.

Every document gets a hash-random key.  Keys are uniform, so the leading hex
digits are an even range partition of each source, however large one source
is: totals of (source, range) give each range its prefix offset, a window
inside the range gives the document's own, and the source's budget is cut
exactly there.  A budget above the source's size repeats whole epochs first.
Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.llm.common import WORD_PATTERN, stored

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
RANGE_DIGITS = 3      # 16^3 key ranges per source
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets per source from (s_null, s_val, source_size): one row per source in and out.

    Weights repeat over the sources in code point order, null last.  All
    sizes are shared by weight; a target stops at ``max_epochs`` times its
    source's size and the excess is shared again by weight.  Filling sources
    in order of cap per weight reaches that fixed point in one pass: a source
    is capped when its cap per weight is at most the level left by those before it.
    """
    everywhere = Window.partitionBy()
    order = Window.orderBy("s_null", "s_val")
    fill = Window.orderBy("ratio", "s_null", "s_val").rowsBetween(Window.unboundedPreceding, -1)
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size").cast("double") * max_epochs
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(fill), F.lit(0.0)))
             / (F.col("weights") - F.coalesce(F.sum("weight").over(fill), F.lit(0.0))))
    capped = F.col("ratio") <= F.col("level")
    free = ((F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everywhere))
            / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everywhere))
    return (sizes.withColumn("weight", pick)
            .withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
            .withColumn("total", F.sum("source_size").over(everywhere).cast("double"))
            .withColumn("weights", F.sum("weight").over(everywhere))
            .withColumn("level", level).withColumn("capped", capped)
            .withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * free))
            .select("s_null", "s_val", "source_size", "target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """All columns of ``docs`` and ``size``, ``source_size``, ``target``, ``taken``.

    Every row stays; ``taken`` is the number of its words in the mix: whole
    epochs plus what the cut leaves (0 to size).  The taken words of a source
    add up to its rounded target.  A null source is a source of its own,
    empty texts take 0, repeated rows are rows of their own (rows equal in id
    and size may exchange their place in the order), an empty table gives an
    empty result.  Input columns of the added names, or beginning with
    ``_mix_``, are replaced.
    """
    given = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")
             and not c.startswith("_mix_")]
    sized = docs.select(
        *[F.col(f"`{c}`") for c in given], word_count(F.col(f"`{text_col}`")).alias("size"),
        F.col(f"`{source_col}`").isNull().alias("_mix_null"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("_mix_val"))
    sized = sized.withColumn("_mix_key", F.md5(F.concat_ws(
        "|", F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")),
        F.col("size").cast("string")).cast("binary")))
    sized = sized.withColumn("_mix_range", F.substring("_mix_key", 1, RANGE_DIGITS))
    part = ["_mix_null", "_mix_val", "_mix_range"]

    totals = stored(sized.groupBy(*part).agg(F.sum("size").alias("n")))   # ranges x sources rows at most
    before = Window.partitionBy("_mix_null", "_mix_val").orderBy("_mix_range").rowsBetween(
        Window.unboundedPreceding, -1)
    sources = totals.groupBy(F.col("_mix_null").alias("s_null"), F.col("_mix_val").alias("s_val")).agg(
        F.sum("n").alias("source_size"))
    plan = (totals.withColumn("_mix_off", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .join(source_targets(sources, weights, max_epochs),
                  (F.col("_mix_null") == F.col("s_null")) & (F.col("_mix_val") == F.col("s_val")))
            .select(*part, "_mix_off", "source_size", "target"))

    own = Window.partitionBy(*part).orderBy("_mix_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sized.join(plan, part).withColumn(
        "_mix_at", F.col("_mix_off") + F.coalesce(F.sum("size").over(own), F.lit(0)))
    budget = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    cut = F.least(F.greatest(rest - F.col("_mix_at"), F.lit(0)), F.col("size"))
    return ranked.withColumn("taken", (epochs * F.col("size") + cut).cast("bigint")).select(
        *[F.col(f"`{c}`") for c in given], "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as its taken words hold it (the one cut document of a
    source goes to the nearer whole number), with the columns of ``docs``.  Wordless documents stay once."""
    mixed = mix_sources(docs, **options)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.round(F.col("taken") / F.col("size"))).cast("int")
    return (mixed.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(0), copies)))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
