"""The driver's queries on the operators of this package, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.bpe import bpe_decode, bpe_encode
from tripmart.llm.decontamination import decontaminate
from tripmart.llm.embedding_dedup import embedding_dedup
from tripmart.llm.exact_dedup import exact_dedup
from tripmart.llm.line_dedup import line_dedup
from tripmart.llm.merkle import merkle_manifest
from tripmart.llm.packing import pack_documents
from tripmart.llm.periodic_runs import periodic_runs
from tripmart.llm.quality import fit_quality, id_remainder, score_quality
from tripmart.llm.secret_scan import BASE_RULES, scan_secrets
from tripmart.llm.simhash import hex_of, simhash_dedup
from tripmart.llm.token_store import read_shards, write_shards
from tripmart.llm.warc import read_warc, write_warc
from tripmart.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


ORACLE_SQL["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"), threshold=0.93)


ORACLE_SQL["op2_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
         sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda c: c * c))) AS norm
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL)) = 0
), ok AS (SELECT * FROM v WHERE norm > 0 AND isfinite(norm)),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  AND list_inner_product(a.x, b.x) / (a.norm * b.norm) >= 0.93
), reach AS (
  SELECT vec_id AS u, vec_id AS r FROM embeddings
  UNION
  SELECT reach.u, link.w FROM reach JOIN link ON reach.r = link.u
), low AS (SELECT u, min(r) AS component_id FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low ON low.u = e.vec_id LEFT JOIN n ON n.u = e.vec_id
"""


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup(table(spark, sf_dir, "documents"), shingle=4, max_distance=4)
    return found.select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id",
        (id_remainder(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe_encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe_decode(coded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", "text")


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_warc(table(spark, sf_dir, "pages"), least_bytes=0)
    return read_warc(spark, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# base32 by hand: four bits for each hex digit of the SHA-1, then a letter for each five bits
ORACLE_SQL["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
b AS (
  SELECT page_id, t, array_to_string(list_transform(range(1, 41), lambda i: substr(
    '0000000100100011010001010110011110001001101010111100110111101111',
    4 * (strpos('0123456789abcdef', substr(sha1(t), CAST(i AS INT), 1)) - 1) + 1, 4)), '') AS bits
  FROM p
), d AS (
  SELECT page_id, t, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * CAST(substr(bits, CAST(5 * i + 1 AS INT), 1) AS INT) + 8 * CAST(substr(bits, CAST(5 * i + 2 AS INT), 1) AS INT)
      + 4 * CAST(substr(bits, CAST(5 * i + 3 AS INT), 1) AS INT) + 2 * CAST(substr(bits, CAST(5 * i + 4 AS INT), 1) AS INT)
      + CAST(substr(bits, CAST(5 * i + 5 AS INT), 1) AS INT), 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY t) AS first
  FROM b
)
SELECT page_id, octet_length(encode(t)) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(table(spark, sf_dir, "documents"), path, end_id=0, capacity=2048).drop("ids")


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = [r.kind for r in BASE_RULES]
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(joined(of(*base)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = write_shards(table(spark, sf_dir, "documents"), path, end_id=2)
    return read_shards(spark, manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def _with_planted_run(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where every tenth checksum of an id makes the words from some place on
    repeat with a period. Words are split off once: the arrays are columns of a generator's row."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    planted = docs.where(h % 10 == 0).select("doc_id", "text", F.floor(h / 10).alias("g"), F.inline(F.array(F.struct(split.alias("words")))))
    n = F.size("words")
    sized = planted.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int")).withColumn(
        "p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    )
    rest = n - F.col("a")
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    copies = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("p")).cast("int"))), 1, rest)
    text = F.when(n > 0, F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), copies), " ")).otherwise(F.col("text"))
    others = docs.where(h.isNull() | (h % 10 != 0)).select("doc_id", "text")
    return others.unionByName(sized.select("doc_id", text.alias("text")))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_with_planted_run(table(spark, sf_dir, "documents")))
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(best[c].alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE_SQL["op12_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)
), dw AS (
  SELECT r, p, n.k, array_to_string(w[p : p + n.k - 1], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d) x JOIN (SELECT DISTINCT k FROM iw) n ON p + n.k - 1 <= len(x.w)
), m AS (SELECT r, p, dw.k, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.k = iw.k),
hits AS (
  SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + k)) AS at FROM (SELECT DISTINCT r, p, k FROM m)) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS t FROM m WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits ON d.r = hits.r LEFT JOIN items ON d.r = items.r
"""


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = merkle_manifest(
        table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
        claimed={"text": F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))},
    )
    steps = F.transform("path", lambda s: F.concat(s["left"], s["right"]))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(steps, ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _field(column: str) -> str:
    return f"coalesce(CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# the checksum's lowest bit by hand: eight steps for each character of the id
ORACLE_SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE c AS (
  SELECT *, list_reduce([4294967295] || flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
    lambda k: [CAST(ord(substr(CAST(doc_id AS VARCHAR), CAST(k AS INT), 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
    lambda x, y: xor(xor(x, y) // 2, 3988292384 * (xor(x, y) % 2))) AS crc
  FROM documents
), f AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_leaf("text")} AS leaf, {_leaf("claimed")} AS claim
  FROM (SELECT *, CASE WHEN crc % 2 = 1 THEN replace(text, chr(10), '') ELSE text END AS claimed FROM c)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS total FROM f
), n AS (
  SELECT 0 AS lvl, source, pos, total, leaf AS h FROM o
  UNION ALL
  SELECT lvl + 1, source, pos // 3, (total + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM n WHERE total > 1 GROUP BY lvl, source, pos // 3, total
), s AS (
  SELECT source, h, lvl, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS total
  FROM n WHERE total = 1
), t AS (
  SELECT 0 AS lvl, pos, total, h FROM s
  UNION ALL
  SELECT lvl + 1, pos // 3, (total + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE total > 1 GROUP BY lvl, pos // 3, total
), fold AS (
  SELECT r, source, 0 AS lvl, pos, total, claim AS h, '' AS proof FROM o
  UNION ALL
  SELECT r, source, lvl + 1, pos // 3, (total + 2) // 3, sha256(string_agg(part, '' ORDER BY spot)),
         any_value(proof) || coalesce(string_agg(part, '' ORDER BY spot) FILTER (WHERE spot <> pos), '')
  FROM (
    SELECT fold.r, fold.source, fold.lvl, fold.pos, fold.total, fold.proof, n.pos AS spot, CASE WHEN n.pos = fold.pos THEN fold.h ELSE n.h END AS part
    FROM fold JOIN n ON n.lvl = fold.lvl AND n.source IS NOT DISTINCT FROM fold.source AND n.pos // 3 = fold.pos // 3
    WHERE fold.total > 1
  ) GROUP BY r, source, lvl, pos, total
), top AS (
  SELECT fold.r, 0 AS lvl, s.pos, s.total, fold.h, fold.proof FROM fold JOIN s ON fold.source IS NOT DISTINCT FROM s.source WHERE fold.total = 1
  UNION ALL
  SELECT r, lvl + 1, pos // 3, (total + 2) // 3, sha256(string_agg(part, '' ORDER BY spot)),
         any_value(proof) || coalesce(string_agg(part, '' ORDER BY spot) FILTER (WHERE spot <> pos), '')
  FROM (
    SELECT top.r, top.lvl, top.pos, top.total, top.proof, t.pos AS spot, CASE WHEN t.pos = top.pos THEN top.h ELSE t.h END AS part
    FROM top JOIN t ON t.lvl = top.lvl AND t.pos // 3 = top.pos // 3 WHERE top.total > 1
  ) GROUP BY r, lvl, pos, total
)
SELECT o.doc_id, o.leaf, s.h AS subroot, root.h AS root, sha256(top.proof) AS proof_sha256, top.h AS folded_root, top.h = root.h AS verified
FROM o JOIN s ON o.source IS NOT DISTINCT FROM s.source JOIN top ON top.r = o.r AND top.total = 1 JOIN (SELECT h FROM t WHERE total = 1) root ON true
"""
