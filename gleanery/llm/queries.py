"""One query for each operator over its whole table, and its SQL twin where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import (
    bytepairs,
    collocations,
    counting,
    fingerprints,
    language,
    lexical,
    licenses,
    packing,
    quality,
    similar,
    substrings,
    urlfilters,
    warc,
)

QUERIES = {}
SQL = {}


def registered(query):
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@registered
def op9_quality_rules(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@registered
def op7_document_fingerprints(spark, folder):
    return fingerprints.compare_with_next(table(spark, folder, "documents").select("doc_id", "text"))


@registered
def op10_language_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs, "doc_id", "text", "lang", language.third("doc_id") != 1)
    held_out = F.coalesce(language.third("doc_id") == 1, F.lit(False)).alias("held_out")
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out, "lang_pred", "score"
    )


@registered
def op5_token_counts(spark, folder):
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        definition = file.read()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return counting.count_tokens(docs, definition).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@registered
def op6_byte_bpe(spark, folder):
    ranks = bytepairs.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    pairs = bytepairs.BytePairs(spark, ranks, public_tokenizers.PATTERN)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pairs.round_trip(docs).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@registered
def op3_packing(spark, folder):
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        definition = file.read()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, definition, public_tokenizers.PATTERN)


@registered
def op8_warc(spark, folder):
    path = warc.archive_folder(spark)
    warc.write_archive(table(spark, folder, "pages"), path)
    return warc.read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL["op8_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS hex FROM pages
), q AS (
  SELECT page_id, octet_length(body) AS n, hex,
         max(page_id) OVER (PARTITION BY hex, octet_length(body)) AS kept
  FROM p
), bits AS (
  SELECT *, list_transform(range(0, 8), lambda i: ('0x' || hex[5 * i + 1 : 5 * i + 5])::BIGINT) AS g FROM q
)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
           ((g[j // 4 + 1] >> (15 - 5 * (j % 4))) & 31) + 1]), '') AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to
FROM bits
"""


@registered
def op1_ngram_jaccard_join(spark, folder):
    return similar.jaccard_components(table(spark, folder, "documents").select("doc_id", "text"))


@registered
def op4_substring_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256")
    )


SQL["op4_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 34], ' ') AS s
  FROM w, unnest(range(1, len(ws) - 33)) AS t(i)
), repeated AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS c FROM windows
  ) WHERE c > 1
), gone AS (
  SELECT DISTINCT doc_id, p FROM repeated, unnest(range(i, i + 35)) AS t(p)
), removed AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE
         list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN removed USING (doc_id)
"""


SQL["op1_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
  FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, a AS r FROM both_ways
  UNION
  SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a
), smallest AS (
  SELECT doc_id, min(r) AS m FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(m, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest USING (doc_id)
"""

SQL["op9_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), windows AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 7], ' ') AS s FROM w, unnest(range(1, len(ws) - 6)) AS u(i)
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_rep
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM windows) x,
       unnest(range(i, i + 8)) AS v(p)
  WHERE c > 1 GROUP BY doc_id
), lines AS (
  SELECT doc_id, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS own
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
), counted AS (
  SELECT *, len(own) AS n, (length(l) - length(replace(l, '!!', ''))) / 2 AS shouts,
         length(l) - length(replace(l, '|', '')) AS bars, length(l) - length(translate(l, '#*$%&<>', '')) AS signs
  FROM lines
), judged AS (
  SELECT doc_id, l, n, n > 0 AND (
    NOT regexp_matches(l, '\p{{L}}') OR regexp_matches(l, '{quality.BOILERPLATE}')
    OR (n < 3 AND NOT regexp_matches(trim(l), '{quality.CLOSED.replace("'", "''")}'))
    OR (bars >= 2 AND bars * 100 >= length(l) * 4) OR (signs >= 2 AND signs * 100 >= length(l) * 5)
    OR (shouts >= 3 AND shouts * 100 >= n * 30) OR (n >= 20 AND len(list_distinct(own)) * 100 < n * 40 AND (n <= 500
      OR list_sum(list_transform(range(1, n + 1, 500), lambda i: len(list_distinct(own[i : i + 499])))) * 100 < n * 40
      OR (n - 7 - len(list_distinct(list_transform(range(1, n - 6), lambda i: array_to_string(own[i : i + 7], ' '))))) * 100
         >= (n - 7) * 15))
  ) AS fails FROM counted
), by_doc AS (
  SELECT doc_id, coalesce(sum(n) FILTER (fails), 0) AS lost,
         count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS dup
  FROM judged GROUP BY doc_id
), base AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS chars,
         length(t) - length(translate(t, '{quality.SYMBOLS}', '')) AS symbols, coalesce(n_rep, 0) AS n_rep
  FROM w LEFT JOIN repeated USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, chars::BIGINT AS word_chars, symbols::BIGINT AS n_symbols,
       dup::BIGINT AS n_dup_lines, n_rep::BIGINT AS n_repeat_words,
       n_words < 20 OR 100 * n_rep > 30 * n_words AS base_failed,
       n_words >= 20 AND 100 * n_rep <= 30 * n_words AND lost * 100 <= n_words * 40 AS kept
FROM base JOIN by_doc USING (doc_id)
"""


def number_of(text: Column, seed: str) -> Column:
    """A number below 2 to the 24 that depends on the text, the same in SQL."""
    return F.conv(F.substring(F.md5(F.concat(text, F.lit(seed))), 1, 6), 16, 10).cast("int")


@registered
def op2_url_filters(spark, folder):
    """Pages have no fetch day and come without lists; both follow from their URLs.

    A third of all hosts is listed for a time and some again later; of the domains above
    them an eighth; and a ninth of the first path steps.
    """
    pages = table(spark, folder, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_on", number_of(F.col("url"), "fetch") % 365)
    host = urlfilters.host_of(F.col("url"))
    step = F.regexp_extract(F.lower("url"), urlfilters.ADDRESS, 2)
    first = F.concat(host, F.regexp_extract(step, "^(/[^/]+)", 1))
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)

    def dated(name, key, part):
        keys = pages.select(key.alias("key")).filter("key is not null and key <> ''").distinct()
        day = number_of(F.col("key"), name) % 300
        keys = keys.filter(number_of(F.col("key"), "pick") % part == 0)
        history = [(day, True), (day + 40, False), (F.when(day % 2 == 0, day + 55), True)]
        events = F.explode(F.array(*[F.struct(d.alias("day"), F.lit(on).alias("listed")) for d, on in history]))
        return keys.select(F.lit(name).alias("list"), "key", events.alias("e")).select("list", "key", "e.*")

    entries = dated("hosts", host, 3).union(dated("domains", domain, 8)).union(dated("paths", first, 9))
    return urlfilters.filter_captures(captures, entries).select(
        "page_id", "host", "fetched_on", "n_active", "lists", "matched", "blocked"
    )


SQL["op2_url_filters"] = r"""
WITH parsed AS (
  SELECT page_id, url, nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '\.$', ''), '') AS host,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?[^/?#:]+(?::[0-9]*)?(/[^?#]*)?', 1) AS path,
         ('0x' || substr(md5(url || 'fetch'), 1, 6))::INT % 365 AS fetched_on
  FROM pages
), names AS (
  SELECT DISTINCT 'hosts' AS list, host AS key, 3 AS part FROM parsed
  UNION SELECT DISTINCT 'domains', regexp_extract(host, '([^.]+\.[^.]+)$', 1), 8 FROM parsed
  UNION SELECT DISTINCT 'paths', host || regexp_extract(path, '^(/[^/]+)', 1), 9 FROM parsed
), picked AS (
  SELECT list, key, ('0x' || substr(md5(key || list), 1, 6))::INT % 300 AS day FROM names
  WHERE key <> '' AND ('0x' || substr(md5(key || 'pick'), 1, 6))::INT % part = 0
), active AS (
  SELECT list, key, day AS a, day + 40 AS b FROM picked
  UNION ALL SELECT list, key, day + 55, 100000 FROM picked WHERE day % 2 = 0
), labels AS (
  SELECT page_id, host, fetched_on, string_split(host, '.') AS l,
         list_filter(string_split(path, '/'), lambda x: x <> '') AS s FROM parsed WHERE host IS NOT NULL
), keys AS (
  SELECT page_id, fetched_on, array_to_string(l[i:], '.') AS key FROM labels, unnest(range(1, len(l) + 1)) AS t(i)
  UNION SELECT page_id, fetched_on, host || '/' || array_to_string(s[1:i], '/')
  FROM labels, unnest(range(1, len(s) + 1)) AS t(i)
), found AS (
  SELECT page_id, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
         string_agg(DISTINCT key, ' ' ORDER BY key) AS matched
  FROM keys JOIN active USING (key) WHERE a <= fetched_on AND fetched_on < b GROUP BY page_id
)
SELECT page_id, host, fetched_on, coalesce(n, 0)::BIGINT AS n_active, coalesce(lists, '') AS lists,
       coalesce(matched, '') AS matched, n IS NOT NULL AS blocked
FROM parsed LEFT JOIN found USING (page_id)
"""


@registered
def op11_license_scans(spark, folder):
    return licenses.scan(table(spark, folder, "documents").select("doc_id", "text"))


@registered
def op12_phrase_collocations(spark, folder):
    return collocations.mine(table(spark, folder, "documents").select("lang", "text"))


SQL["op12_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS s FROM documents
), w AS (
  SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS ws FROM pieces
), one AS (
  SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(ws) AS x FROM w) GROUP BY ALL
), two AS (
  SELECT lang, x, y, count(*) AS f FROM (
    SELECT lang, ws[i] AS x, ws[i + 1] AS y FROM w, unnest(range(1, len(ws))) AS t(i)) GROUP BY ALL
), three AS (
  SELECT lang, x, y, z, count(*) AS f FROM (
    SELECT lang, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z FROM w, unnest(range(1, len(ws) - 1)) AS t(i))
  GROUP BY ALL HAVING count(*) >= 10
), sizes AS (
  SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang
), pairs AS (
  SELECT lang, two.x || ' ' || two.y AS phrase, two.f AS a, p.f AS l, q.f AS r,
         1000000::HUGEINT * two.f * two.f // (p.f::HUGEINT * q.f) AS score, two.x AS x, two.y AS y
  FROM two JOIN one p USING (lang) JOIN one q USING (lang) WHERE p.x = two.x AND q.x = two.y AND two.f >= 10
), cuts AS (
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.f AS a,
         1000000::HUGEINT * t.f * t.f // (p.f::HUGEINT * v.f) AS s1, p.f AS l1, v.f AS r1,
         1000000::HUGEINT * t.f * t.f // (u.f::HUGEINT * q.f) AS s2, u.f AS l2, q.f AS r2
  FROM three t JOIN one p ON p.lang = t.lang AND p.x = t.x JOIN one q ON q.lang = t.lang AND q.x = t.z
  JOIN two u ON u.lang = t.lang AND u.x = t.x AND u.y = t.y
  JOIN two v ON v.lang = t.lang AND v.x = t.y AND v.y = t.z
), candidates AS (
  SELECT lang, phrase, a, l, r, score FROM pairs WHERE NOT EXISTS (
    SELECT 1 FROM three t WHERE t.lang = pairs.lang AND 100 * t.f >= 50 * pairs.a AND t.x = pairs.x AND t.y = pairs.y)
  AND NOT EXISTS (
    SELECT 1 FROM three t WHERE t.lang = pairs.lang AND 100 * t.f >= 50 * pairs.a AND t.y = pairs.x AND t.z = pairs.y)
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
  FROM cuts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM candidates
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


@registered
def op13_lexical_search(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lexical.search(docs, table(spark, folder, "benchmark").select("item_id", "text"))


SQL["op13_lexical_search"] = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+')) AS t FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+')) AS t FROM benchmark
), counts AS (
  SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL
), lengths AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY ALL
), whole AS (
  SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM lengths
), w AS (
  SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, whole GROUP BY t, nn
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // ll))))::BIGINT AS score
  FROM q JOIN counts USING (t) JOIN w USING (t) JOIN lengths USING (doc_id), whole GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
