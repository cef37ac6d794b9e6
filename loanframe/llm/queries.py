"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe.llm import (
    alignment, collocations, embedding_dedup, exact_dedup, language, licences, mixing, packing, pii, quality, simhash, topk_search, warc,
)
from loanframe.llm.common import new_folder, remainder, table


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    trees = quality.fit(docs, labels.filter(remainder("doc_id", 4) != 2), "quality")
    return quality.scores(docs, trees).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= quality.GOOD).cast("int").alias("predicted"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.decisions(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP2_SQL = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
"""


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    found = packing.pack_documents(table(spark, folder, "documents"), vocabulary())
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.summary(pii.spans(table(spark, folder, "documents")))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    found = language.identify(table(spark, folder, "documents"), remainder("doc_id", 5) != 0)
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op8_license(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return plan.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("mix_size")).alias("taken"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
             CAST([3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight FROM s),
o AS (SELECT *, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS total,
             coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
             sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_ FROM w),
l AS (SELECT *, (total - full_) / open_ AS level, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM o),
t AS (SELECT source, source_size, cap, weight, arg_min(level, place) FILTER (level * weight <= cap) OVER () AS level FROM l),
g AS (SELECT source, source_size, round(least(cap, coalesce(level * weight, cap)), 6) AS target FROM t),
r AS (SELECT d.doc_id, d.size, g.source_size, g.target,
             CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
             CAST(('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * least(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END, 2) AS BIGINT) AS taken FROM r
"""


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.write(warc.records(table(spark, folder, "pages")), new_folder(spark, "warc"))
    return warc.read(index, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS first, sha1(h) AS s FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       translate(lpad(to_base(CAST('0x' || substr(s, 1, 10) AS BIGINT), 32), 8, '0') || lpad(to_base(CAST('0x' || substr(s, 11, 10) AS BIGINT), 32), 8, '0')
              || lpad(to_base(CAST('0x' || substr(s, 21, 10) AS BIGINT), 32), 8, '0') || lpad(to_base(CAST('0x' || substr(s, 31, 10) AS BIGINT), 32), 8, '0'),
              '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


def op11_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(coalesce(list_inner_product(a.q, b.q), 0) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r),
k AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5
"""


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = alignment.align(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents").select("lang", "text"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
                  string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM d),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, m, list_aggregate(w[i:i + m - 1], 'string_agg', ' ') AS phrase
      FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) t(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM g GROUP BY lang, m, phrase HAVING count(*) >= 30),
c AS (SELECT lang, m, phrase, f AS a, w FROM f WHERE m > 1),
inside AS (SELECT lang, list_aggregate(w[s:s + k - 1], 'string_agg', ' ') AS phrase, max(a) AS longer
           FROM c, (VALUES (1, 2), (2, 2), (3, 2), (1, 3), (2, 3)) t(s, k) WHERE k < m AND s + k - 1 <= m GROUP BY 1, 2),
kept AS (SELECT c.* FROM c LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
cuts AS (SELECT kept.lang, kept.phrase, a, k, h.f AS l, t.f AS r, CAST(2000000::HUGEINT * a // (h.f::HUGEINT + t.f) AS BIGINT) AS score
         FROM kept, (VALUES (1), (2), (3)) x(k), f h, f t
         WHERE k < kept.m AND h.lang = kept.lang AND h.phrase = list_aggregate(kept.w[1:k], 'string_agg', ' ')
           AND t.lang = kept.lang AND t.phrase = list_aggregate(kept.w[k + 1:kept.m], 'string_agg', ' ')),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM low JOIN total USING (lang) QUALIFY rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality, op2_exact_dedup, op3_embedding_dedup, op4_simhash_dedup, op5_best_fit_packing, op6_pii, op7_language, op8_license, op9_mixing, op10_warc,
        op11_topk_search, op12_token_alignment, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op9_mixing": OP9_SQL, "op10_warc": OP10_SQL, "op11_topk_search": OP11_SQL, "op13_collocations": OP13_SQL}
