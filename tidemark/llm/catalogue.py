"""The registered query of each text operator, and its SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import table
from .alignment import align_documents, count_links
from .bpe import decode_documents, encode_documents
from .decontamination import contaminated
from .html_extraction import extract_pages
from .jaccard_join import jaccard_components
from .license_scan import fit_licences, scan_licences
from .lm_scoring import lm_scores
from .mixing import mix_sources
from .quality_rules import fit_field, judge_quality
from .spelling import count_words, runs, spelling_forms, without
from .token_counts import token_counts
from .toxicity import fit_toxicity, held_out, score_toxicity
from .warc import archive_round_trip


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return scan_licences(documents, fit_licences(documents))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short=True)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return judge_quality(documents, fit_field(documents, table(spark, sf_dir, "labels")))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scores(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", F.round("mean_log_score", 6).alias("mean_log_score"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = score_toxicity(documents, fit_toxicity(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "sentence_score", "sentence")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_documents(encode_documents(table(spark, sf_dir, "documents")))
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_documents(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    aligned = aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "copies", "batch")
    return count_links(aligned, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs(table(spark, sf_dir, "documents"), ["doc_id"])
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    word = F.when(h % 97 == 0, without(F.col("run"), h % F.char_length("run"))).otherwise(F.col("run"))
    return spelling_forms(count_words(found.select(word.alias("word"))))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_mix_sources": op3_mix_sources,
    "op4_token_counts": op4_token_counts,
    "op5_html_extraction": op5_html_extraction,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_warc": op8_warc,
    "op10_quality_rules": op10_quality_rules,
    "op9_toxicity": op9_toxicity,
    "op11_bpe": op11_bpe,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_spelling_variants": op13_spelling_variants,
}

_WORDS6 = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_ALNUM = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

ORACLES = {
    "op2_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS ws FROM documents),
b AS (SELECT item_id, ws, len(ws) AS n, least(5, len(ws)) AS s FROM (SELECT item_id, {_ALNUM} AS ws FROM benchmark WHERE item_id IS NOT NULL) WHERE len(ws) > 0),
bs AS (SELECT item_id, n, s, array_to_string(ws[i : i + s - 1], ' ') AS sh, count(*) AS k
       FROM (SELECT *, unnest(range(1, n - s + 2)) AS i FROM b) GROUP BY ALL),
ds AS (SELECT doc_id, len(ws) AS m, s, i, array_to_string(ws[i : i + s - 1], ' ') AS sh
       FROM (SELECT d.doc_id, d.ws, z.s, unnest(range(1, len(d.ws) - z.s + 2)) AS i FROM d, (SELECT DISTINCT s FROM b) z WHERE len(d.ws) >= z.s)),
h AS (SELECT ds.doc_id, ds.m, ds.i, bs.* FROM ds JOIN bs ON ds.sh = bs.sh AND ds.s = bs.s),
p AS (SELECT *, unnest(range(greatest(1, i - (n - s)), least(i, greatest(m - n, 0) + 1) + 1)) AS a FROM h),
c AS (SELECT doc_id, item_id, m, n, s, a, sh, least(count(*), any_value(k)) AS k FROM p GROUP BY doc_id, item_id, m, n, s, a, sh),
w AS (SELECT doc_id, item_id, a, sum(k)::BIGINT AS o, (n - s + 1 + least(n, m) - s + 1 - sum(k))::BIGINT AS u FROM c GROUP BY doc_id, item_id, m, n, s, a),
v AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY o DESC, a) AS r FROM w WHERE 10 * o >= 8 * u)
SELECT doc_id, item_id, o / u AS similarity, o AS overlap, u AS union_size, a - 1 AS first_word FROM v WHERE r = 1
""",
    "op5_html_extraction": r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)', 1), '(?s)</article.*|<[a-zA-Z/][^>]*$', '') AS body FROM pages),
b AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(body, '</?(p|h1)>', chr(1), 'g'), '<br>', ' ', 'g'), chr(1)) AS parts FROM a),
c AS (SELECT page_id, url, list_transform(parts, lambda x: regexp_replace(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g')) AS parts FROM b),
d AS (SELECT page_id, url, list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS parts FROM c),
e AS (SELECT page_id, url, coalesce(array_to_string(parts, chr(10)), '') AS text FROM d)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM e
""",
    "op6_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS6} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT o.a, o.b FROM o JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.c)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
""",
    "op7_lm_scoring": f"""
WITH w AS (SELECT doc_id, {_WORDS6} AS ws FROM documents),
t AS (SELECT doc_id, i, ws[i] AS g1, CASE WHEN i > 1 THEN array_to_string(ws[i - 1 : i], ' ') END AS g2, CASE WHEN i > 2 THEN array_to_string(ws[i - 2 : i], ' ') END AS g3
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
a AS (SELECT *, count(*) OVER () - count(*) OVER (PARTITION BY doc_id) AS n,
      count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY g1, doc_id) AS c1,
      count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY g2, doc_id) AS c2,
      count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY g3, doc_id) AS c3 FROM t),
h AS (SELECT *, lag(c1) OVER d AS h1, lag(c2) OVER d AS h2 FROM a WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT doc_id, CASE WHEN g3 IS NOT NULL AND c3 > 0 THEN ln(c3 / h2)
      WHEN g2 IS NOT NULL AND c2 > 0 THEN ln(c2 / h1) + CASE WHEN g3 IS NOT NULL THEN ln(0.4) ELSE 0 END
      ELSE CASE WHEN c1 > 0 THEN ln(c1 / n) ELSE -ln(n + 1) END + least(i - 1, 2) * ln(0.4) END AS x FROM h)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, round(m.x / len(d.ws), 6) AS mean_log_score
FROM w d LEFT JOIN (SELECT doc_id, sum(x) AS x FROM s GROUP BY doc_id) m USING (doc_id)
""",
    "op8_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM m
""",
}
