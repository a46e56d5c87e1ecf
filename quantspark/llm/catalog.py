"""The registered opN_* queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.llm.common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.mixing import mix_sources
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op2_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::DOUBLE AS w
  FROM d GROUP BY source),
r AS (SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / w AS ratio,
             sum(source_size) OVER ()::DOUBLE AS total, sum(w) OVER () AS ws FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER f, 0)) / (ws - coalesce(sum(w) OVER f, 0)) AS level FROM r
      WINDOW f AS (ORDER BY ratio, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
             CASE WHEN ratio <= level THEN cap
                  ELSE w * ((total - sum(CASE WHEN ratio <= level THEN cap ELSE 0 END) OVER ())
                            / sum(CASE WHEN ratio > level THEN w END) OVER ()) END AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source
               ORDER BY md5('mix-1|' || coalesce(d.doc_id::VARCHAR, '') || '|' || d.size::VARCHAR), d.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before_it
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
        + least(greatest(CASE WHEN source_size > 0 THEN budget % source_size ELSE 0 END - before_it, 0), size))::BIGINT AS taken
FROM p
"""


@query
def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.topk import top_k
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE["op4_top_k"] = r"""
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.sharding import shard_documents
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.secret_scan import scan_documents
    return scan_documents(table(spark, sf_dir, "documents")).drop("findings")


@query
def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.neardup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op9_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n_shingles FROM g),
u AS (SELECT doc_id, unnest(s) AS s FROM g),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM u x JOIN u y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
      WHERE 100 * shared >= 75 * (p.n_shingles + q.n_shingles - shared)),
r AS (SELECT doc_id, doc_id AS m FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.m)
SELECT n.doc_id, n.n_shingles, k.m AS component_id, n.doc_id = k.m AS kept
FROM n JOIN (SELECT doc_id, min(m) AS m FROM r GROUP BY 1) k USING (doc_id)
"""


@query
def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.class_lm import class_lm_scores
    return class_lm_scores(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) == 2)


@query
def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.imatch import fingerprints
    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.toxicity import score_documents, train_toxicity
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out)
    return score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.wrapper import main_texts
    return main_texts(table(spark, sf_dir, "pages"))


@query
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.common import stored
    from quantspark.llm.quality import score_quality, text_statistics, train_quality
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    stats = stored(text_statistics(table(spark, sf_dir, "documents")))
    model = train_quality(stats, table(spark, sf_dir, "labels"), ~held_out)
    return score_quality(stats, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.whitening import whitened_rows
    return whitened_rows(table(spark, sf_dir, "embeddings"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quantspark.llm.common import ascii_lower
    from quantspark.llm.merkle import merkle_manifest
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.when(hit, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return merkle_manifest(table(spark, sf_dir, "documents"), {"text": lowered})


def _merkle_sql(levels: int = 6, top_levels: int = 3) -> str:
    """The manifest level by level, up to 8^levels rows a language and 8^top_levels languages."""
    def item(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(item(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bit = "(CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)"
    steps = "".join(f", c{i + 1} AS (SELECT b, {bit} AS v FROM c{i})" for i in range(8))
    sql = f"""WITH c0 AS (SELECT b, b::BIGINT AS v FROM range(256) t(b)){steps},
k AS (SELECT list(v ORDER BY b) AS tab FROM c8),
x AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(y)::BIGINT FOR y IN string_split(doc_id::VARCHAR, '')]),
        lambda c, y: xor(c // 256, tab[xor(c % 256, y) + 1])), 4294967295) % 3 = 0 AS hit FROM documents, k),
l AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf('text')} AS leaf,
        CASE WHEN hit THEN {leaf(lowered)} ELSE {leaf('text')} END AS cur FROM x),
d0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, cur) - 1 AS pos, '' AS sib FROM l),
n0 AS (SELECT tree, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS total FROM d0)"""

    def climb(i: int, rows: str, nodes: str, place: str) -> str:
        kids = "string_agg(h, '' ORDER BY pos)"
        left, right = "substr(kids, 1, 64 * s)", "substr(kids, 64 * (s + 1) + 1)"
        return f""",
{nodes}{i + 1} AS (SELECT tree, pos // 8 AS pos, CASE WHEN max(total) = 1 THEN max(h) ELSE sha256({kids}) END AS h,
        (max(total) + 7) // 8 AS total, max(total) AS below, {kids} AS kids FROM {nodes}{i} GROUP BY tree, pos // 8),
{rows}{i + 1} AS (SELECT * EXCLUDE (s, kids, below, cur, sib),
        CASE WHEN below = 1 THEN cur ELSE sha256({left} || cur || {right}) END AS cur,
        CASE WHEN below = 1 THEN sib ELSE sib || {left} || {right} END AS sib
      FROM (SELECT r.*, n.kids, n.below, (r.{place} // {8**i}) % 8 AS s FROM {rows}{i} r
            JOIN {nodes}{i + 1} n ON n.tree = r.{'tree' if rows == 'd' else 'one'} AND n.pos = r.{place} // {8**(i + 1)}))"""

    for i in range(levels):
        sql += climb(i, "d", "n", "pos")
    sql += f""",
m0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, count(*) OVER () AS total, tree AS name FROM n{levels}),
e0 AS (SELECT d.*, m0.pos AS tpos, m0.h AS subroot, '' AS one FROM d{levels} d JOIN m0 ON m0.name = d.tree)"""
    for i in range(top_levels):
        sql += climb(i, "e", "m", "tpos")
    return sql + f"""
SELECT doc_id, leaf, subroot, m.h AS root, sha256(sib) AS proof_sha256, cur AS folded_root, cur = m.h AS verified
FROM e{top_levels}, m{top_levels} m"""


ORACLE["op13_merkle_manifest"] = _merkle_sql()
