"""The operators of this folder as named queries over the shared tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factgrade.llm import collocations, decontaminate, filteraudit, language, licenses, neardup, pieces, pii, quality, secrets, sharding, topk, warc
from factgrade.sources.storage import shared_folder
from factgrade.llm.common import materialise, of_kinds, span_text, table


def op5_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def digests(found: DataFrame, spans: str, kinds: tuple[str, ...], base: Column) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    counts = [F.size(of_kinds(base, (k,))).cast("bigint").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col(spans)).alias("spans"))


def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf, "documents"))
    return digests(found, "pii", pii.KINDS, F.filter("pii", lambda s: s["base"]))


def op2_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf, "documents"))
    kinds = secrets.KINDS[:3]
    return digests(found, "secrets", kinds, of_kinds(F.col("secrets"), kinds))


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op4_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf, "documents"))


def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.score_documents(table(spark, sf, "documents"))


def op8_licenses(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.scan(table(spark, sf, "documents"))
    starts = F.transform("places", lambda p: p["start"])
    base = F.transform("places", lambda p: p["label"])
    shares = F.transform("matches", lambda m: m["containment"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        licenses.label_text(base).alias("base_labels"),
        licenses.label_text(F.concat(base, F.transform("matches", lambda m: m["label"]))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(shares), F.lit(0.0))).alias("score"),
    )


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    warc.write(table(spark, sf, "pages"), folder)
    captures = warc.assemble(materialise(warc.read(spark, folder, payload=False), "records"))
    return captures.select(
        F.col("metadata.fields")["page-id"].cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("metadata.fields")["refers-to-page-id"].cast("bigint").alias("refers_to"),
    )


def op10_neardup(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf, "documents"))


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.best_phrases(table(spark, sf, "documents"))


def op12_filteraudit(spark: SparkSession, sf: str) -> DataFrame:
    return filteraudit.audit(filteraudit.failed_sets(table(spark, sf, "documents"), table(spark, sf, "labels")))


def op13_sharding(spark: SparkSession, sf: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    )
    dealt = sharding.shuffle(docs, 16)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_secrets": op2_secrets,
    "op3_quality": op3_quality,
    "op4_pieces": op4_pieces,
    "op5_topk": op5_topk,
    "op6_decontaminate": op6_decontaminate,
    "op7_language": op7_language,
    "op8_licenses": op8_licenses,
    "op9_warc": op9_warc,
    "op10_neardup": op10_neardup,
    "op11_collocations": op11_collocations,
    "op12_filteraudit": op12_filteraudit,
    "op13_sharding": op13_sharding,
}

WORDS_SQL = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE: dict[str, str] = {
    "op12_filteraudit": r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
             + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t))::INT
             + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS failed
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed),
x AS (SELECT unnest(range(5)) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT list_aggregate([('ABCDE')[i + 1] for i in o], 'string_agg', '') AS filter_order, step, o[step] AS filter,
             1 << o[step]::INT AS bit, list_sum([(1 << i::INT) for i in list_slice(o, 1, step - 1)]) AS state
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, filter, coalesce(state, 0)::INT AS state, bit,
             sum(CASE WHEN failed & (coalesce(state, 0)::INT | bit::INT) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN failed & coalesce(state, 0)::INT = 0 AND failed & bit::INT <> 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN failed & coalesce(state, 0)::INT <> 0 AND failed & bit::INT <> 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN failed = bit THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN failed & coalesce(state, 0)::INT = 0 AND failed & bit::INT <> 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN failed & coalesce(state, 0)::INT = 0 AND failed & bit::INT <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM s, c GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM r""",
    "op11_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
g AS (SELECT lang, k, list_slice(w, i, i + k - 1) AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
      FROM p, (SELECT unnest(range(1, 5)) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, g, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 30),
cut AS (SELECT lang, k, g, f, unnest(range(1, k)) AS j FROM c),
s AS (SELECT cut.lang, cut.g, cut.f AS a, j, x.f AS l, y.f AS r, 2000000 * cut.f // (x.f + y.f) AS score FROM cut
      JOIN f x ON x.lang = cut.lang AND x.g = list_slice(cut.g, 1, j) JOIN f y ON y.lang = cut.lang AND y.g = list_slice(cut.g, j + 1, cut.k)),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
inner_ AS (SELECT lang, list_slice(g, i, i + m - 1) AS g, max(f) AS f
           FROM (SELECT lang, g, f, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k) GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN inner_ i ON i.lang = b.lang AND i.g = b.g WHERE i.f IS NULL OR 100 * i.f < 80 * b.a),
t AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM kept),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM t)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM q JOIN n USING (lang) WHERE rank <= 2000""",
    "op6_decontaminate": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS_SQL}, []) AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, list_slice(w, i, i + least(13, len(w)) - 1) AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
p AS (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k),
hit AS (SELECT r, i, bw.k, item_id FROM p JOIN bw ON bw.k = p.k AND bw.g = list_slice(p.w, p.i, p.i + p.k - 1)),
n AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM hit) GROUP BY r),
t AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)""",
    "op8_licenses": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce({WORDS_SQL}, []) AS w FROM documents),
p AS (SELECT * FROM (VALUES {", ".join(f"({p.split()!r}, '{label}')" for p, label in licenses.PHRASES.items())}) AS v(phrase, label)),
place AS (SELECT r, i - 1 AS start, label FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d) JOIN p
          ON list_slice(w, i, i + len(phrase) - 1) = phrase),
base AS (SELECT r, count(*) AS n, min(start) AS a, max(start) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM place GROUP BY r),
t AS (SELECT label, list_distinct(string_split(text, ' ')) AS tokens FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in licenses.TEMPLATES)}) AS v(label, text)),
b AS (SELECT r, unnest(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '\n[ \t\r]*\n'))) AS text FROM d),
m AS (SELECT r, label, len(list_intersect(list_distinct({WORDS_SQL}), tokens)) / len(tokens) AS c FROM b, t
      WHERE len(list_intersect(list_distinct({WORDS_SQL}), tokens)) >= {licenses.THRESHOLD} * len(tokens) - 1e-9),
best AS (SELECT r, max(c) AS c FROM m GROUP BY r),
l AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT r, label FROM m UNION ALL SELECT r, label FROM place) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, b::BIGINT AS last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN best USING (r) LEFT JOIN l USING (r)""",
    "op9_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
o AS (SELECT *, CASE WHEN n >= 100 AND page_id IS NOT NULL THEN min(page_id) OVER (PARTITION BY html) END AS owner FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN owner < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN owner < page_id THEN owner END AS refers_to FROM o""",
    "op5_topk": """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20""",
}
