"""Registered queries of the corpus operators: thin digests over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricbook.llm import (divergence, langid, mixing, packing, pii, qda, rules, simhash, tokencount, urlfilter, variants,
                            warc, winnowing)
from metricbook.llm.common import read, shared_dir

POLICY = "v3"
PII_KEY = "corpus-surrogates-1"

#: The listed urls of op3.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
             ("net/fr/", "block")]


#: Session setting that names a lasting digest cache for op12; unset, each run begins with an empty one.
TOKEN_CACHE = "metricbook.tokenCache"
TOKEN_LIMIT = 4096


def _remainder(n: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = winnowing.with_next_row(docs, "doc_id", {"next_text": "text"}, ["text"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       winnowing.selected(F.col("text")).alias("own"), winnowing.selected(F.col("edited")).alias("other"),
                       winnowing.selected(F.col("next_text")).alias("following"))
    own, other, following = (winnowing.hashes(F.col(c)) for c in ("own", "other", "following"))
    return rows.select("doc_id", "n_chars", "edited_sha256", winnowing.as_text(F.col("own")).alias("fingerprint"),
                       winnowing.as_text(F.col("other")).alias("edited_fingerprint"),
                       winnowing.likeness(own, other).alias("near_edited"), winnowing.likeness(own, following).alias("near_next"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), ["doc_id"])


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return urlfilter.judge(read(spark, sf_dir, "pages"), entries, ["page_id"])


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qda.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "doc_id", _remainder(3) == 1)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(read(spark, sf_dir, "documents"), ["doc_id"], added=packing.default_added())
    return packing.pack(pieces, ["doc_id", "piece", "ids_crc32"])


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive_and_read(read(spark, sf_dir, "pages"))
    return back.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest",
                       F.col("type").alias("record_type"), "refers_to", "intact")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, PII_KEY, report=True)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"), "doc_id", _remainder(4) == 2)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = rules.ledger(read(spark, sf_dir, "documents"), ["doc_id"])
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~rules.passes("base")).alias("base_failed"), rules.passes(POLICY).alias("kept"), "failed_bits")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"), "doc_id", ["doc_id"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("component").alias("component_id"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(variants.count_words(read(spark, sf_dir, "documents"), "doc_id", every=97))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = spark.conf.get(TOKEN_CACHE, None) or f"{shared_dir(spark)}/token-cache-{uuid.uuid4().hex}"
    counted = tokencount.count_tokens(read(spark, sf_dir, "documents"), ["doc_id"], cache)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy costs, from the ledger's bits alone."""
    return rules.ablations(rules.ledger(read(spark, sf_dir, "documents"), []), POLICY)


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_mixing, op3_url_filter, op4_quality, op5_packing, op6_warc,
                                   op7_pii, op8_language, op9_quality_rules, rule_ablations, op10_simhash, op11_variants,
                                   op12_token_counts, op13_source_divergence)}

_OP9 = r"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), spots AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), runs AS (
    SELECT doc_id, i, word || ' ' || lead(word, 1) OVER d || ' ' || lead(word, 2) OVER d || ' ' || lead(word, 3) OVER d
           || ' ' || lead(word, 4) OVER d || ' ' || lead(word, 5) OVER d || ' ' || lead(word, 6) OVER d
           || ' ' || lead(word, 7) OVER d AS run
    FROM spots WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs WHERE run IS NOT NULL
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows WHERE n >= 2) GROUP BY doc_id
), m AS (
    SELECT w.doc_id, len(words)::BIGINT AS n_words,
           coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_same, 0) AS n_same
    FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN (
        SELECT doc_id, count(*) FILTER (word = before) AS n_same
        FROM (SELECT doc_id, word, lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM spots) GROUP BY doc_id
    ) USING (doc_id)
), b AS (
    SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END
             + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END
             + CASE WHEN n_lines >= 6 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
             + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words) THEN 16 ELSE 0 END
             + CASE WHEN 100 * n_same > 30 * n_words THEN 32 ELSE 0 END
             )::BIGINT AS failed_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM b
"""

_OP3 = r"""
WITH p AS (
    SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), h AS (
    SELECT page_id, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r(rule, rule_host, rule_path, verdict) AS (
    VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
           ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
           ('net/fr/', 'net', '/fr/', 'block')
), j AS (
    SELECT h.*, r.rule, r.verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(r.rule) DESC) AS n
    FROM h LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM j WHERE n = 1
"""

_OP6 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS hex FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_page FROM h)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '')
           AS payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_page THEN first_page END AS refers_to, TRUE AS intact
FROM f
"""

_OP13 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(
        coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), o AS (
    SELECT r, lang, source, unnest(terms) AS term FROM d
), kept AS (
    SELECT lang, term, count(*)::HUGEINT AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), l AS (
    SELECT lang, coalesce(count(term), 0)::HUGEINT AS v, coalesce(sum(n), 0)::HUGEINT AS total
    FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang
), c AS (
    SELECT lang, source, term, count(*)::HUGEINT AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
    SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
    FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source
), p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.v) AS p,
           1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
    FROM g JOIN l USING (lang) JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
    SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM pairs LEFT JOIN sums USING (lang, source, item)
), term AS (
    SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

_OP9_ABLATIONS = f"""
WITH l AS (SELECT failed_bits AS b FROM ({_OP9}))
SELECT 'v3' AS policy, rule, count(*) FILTER (b & bit <> 0) AS docs_failing, count(*) FILTER (b = bit) AS docs_only_this,
       count(*) FILTER (b & ~bit = 0) AS kept_without
FROM l, (VALUES ('too_few_words', 1), ('repeated_words', 2), ('symbols', 4), ('duplicate_lines', 8), ('word_length', 16),
                ('stutter', 32)) r(rule, bit)
GROUP BY rule
"""

def _crc_entry(n: int) -> int:
    for _ in range(8):
        n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
    return n


_OP11 = rf"""
WITH RECURSIVE g AS (
    SELECT doc_id, run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS k
    FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
    GROUP BY doc_id, run
), b AS (
    SELECT run, n, list_transform(range(octet_length(encode(k))), lambda i: CAST('0x' || substr(hex(encode(k)), 2 * i + 1, 2) AS BIGINT)) AS bytes FROM g
), h AS (
    SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda c, x:
        xor(c >> 8, list_extract(CAST({[_crc_entry(n) for n in range(256)]} AS BIGINT[]), (xor(c, x) & 255) + 1))), 4294967295::BIGINT) AS h FROM b
), w AS (
    SELECT word, sum(n)::BIGINT AS n
    FROM (SELECT n, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), v AS (
    SELECT word, n, length(word) AS size, i, left(word, i) || substr(word, i + 2) AS cut
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)
), longer AS (
    SELECT DISTINCT v.word AS long, v.n AS long_n, w.word AS short, w.n AS short_n FROM v JOIN w ON w.word = v.cut
), near AS (
    SELECT x.word, y.word AS near, y.n AS near_n FROM v x JOIN v y ON x.i = y.i AND x.cut = y.cut AND x.size = y.size AND x.word <> y.word
    UNION ALL SELECT long, short, short_n FROM longer UNION ALL SELECT short, long, long_n FROM longer
), best AS (
    SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1
), f AS (
    SELECT w.word, CASE WHEN near_n >= 2 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
    FROM w LEFT JOIN best USING (word)
), r(word, root) AS (
    SELECT word, word FROM f WHERE form IS NULL UNION ALL SELECT f.word, r.root FROM f JOIN r ON f.form = r.word
)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN r USING (word)
"""

ORACLE = {"op11_variants": _OP11, "rule_ablations": _OP9_ABLATIONS, "op3_url_filter": _OP3, "op6_warc": _OP6, "op9_quality_rules": _OP9, "op13_source_divergence": _OP13}
