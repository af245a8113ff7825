"""The operators applied to their whole tables, and SQL for DuckDB where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm.decontamination import contamination
from chatterscope.llm.hard_negatives import hard_negatives
from chatterscope.llm.language_id import identify
from chatterscope.llm.line_dedup import line_report
from chatterscope.llm.minhash import near_duplicates
from chatterscope.llm.packing import pack
from chatterscope.llm.periodic_runs import periodic_runs
from chatterscope.llm.pii import personal_data
from chatterscope.llm.quality_rules import STOP_WORDS, quality_rules
from chatterscope.llm.secret_ledger import secrets
from chatterscope.llm.simhash_anchors import simhash_duplicates
from chatterscope.llm.toxicity import toxicity
from chatterscope.llm.url_filter import judge

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, table(spark, sf_dir, "documents"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(spark, table(spark, sf_dir, "documents"))


ORACLE["op4_secrets"] = r"""
WITH rules(kind, rank, pattern, least) AS (VALUES
  ('assign', 0, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+', 12),
  ('access', 1, 'AKIA[A-Z0-9]+', 18), ('hex', 2, '[0-9a-f]{16,}', 16)),
m AS (
  SELECT doc_id, kind, rank, least, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), pattern) AS hits,
    regexp_split_to_array(coalesce(text, ''), pattern) AS gaps
  FROM documents, rules),
p AS (
  SELECT doc_id, kind, rank, least, hits[i] AS hit,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS a
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m)),
s AS (
  SELECT doc_id, kind, rank, CAST(a AS BIGINT) AS a, CAST(a + length(hit) AS BIGINT) AS b FROM p
  WHERE length(CASE WHEN kind = 'assign' THEN regexp_extract(hit, '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1) ELSE hit END) >= least)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank), '') AS spans
FROM documents LEFT JOIN s USING (doc_id) GROUP BY doc_id"""


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op5_decontamination"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS k FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS i FROM b WHERE len(w) >= 10)
  UNION SELECT item_id, w FROM b WHERE len(w) BETWEEN 1 AND 9),
sizes AS (SELECT DISTINCT len(k) AS n FROM win),
spot AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM spot JOIN win USING (k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"), shingle=3, percent=85)


ORACLE["op6_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 2) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)
  UNION SELECT doc_id, w FROM w WHERE len(w) IN (1, 2)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN low USING (doc_id) LEFT JOIN n USING (doc_id)"""


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


ORACLE["op7_url_filter"] = r"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host || '#' || path LIKE 'ads.%' OR host || '#' || path LIKE '%.ads.%'
  OR host || '#' || path LIKE '%/cgi-bin/%' OR host || '#' || path LIKE '%/wp-login.php%' OR host || '#' || path LIKE '%.exe'
  OR host || '#' || path LIKE '%.zip' OR host || '#' || path LIKE '%.mp4' THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN best USING (page_id)"""


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(spark, table(spark, sf_dir, "documents"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


ORACLE["op10_quality_rules"] = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT doc_id, i, list_slice(words, i, i + 7) AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS p
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1)
  GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in STOP_WORDS)}))) AS n_stop,
    len(list_filter(lines, lambda x: ltrim(x, ' ')[1] IN ('-', '*', '•'))) AS n_bullet,
    len(list_filter(lines, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…')) AS n_ellipsis
  FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce(word_chars / n_words BETWEEN 2 AND 15, true) AND coalesce(n_symbols / n_words <= 0.3, true)
    AND coalesce(n_stop / n_words >= 0.02, true) AND coalesce(n_dup_lines / n_lines <= 0.3, true)
    AND coalesce(n_bullet / n_lines <= 0.9, true) AND coalesce(n_ellipsis / n_lines <= 0.3, true) AS kept
FROM b"""


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # A whole number in place of a non-finite one would hide it.
    finite = F.transform("embedding", lambda x: F.when(~F.isnan(x) & (F.abs(x) < float("inf")), F.floor(256 * x.cast("double")).cast("double")))
    return hard_negatives(spark, rows.select("vec_id", label.alias("label"), finite.alias("vector")), F.col("vec_id") % 100 == 0)


ORACLE["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5"""


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(spark, table(spark, sf_dir, "documents"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    # Only texts that are to be rewritten are split here; the explode keeps Spark from splitting anew for each word.
    split = docs.select("*", F.explode(F.array(F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), words))).alias("w"))
    g, n = F.floor(F.col("h") / 10), F.when(F.size("w") > 0, F.size("w"))
    first = split.select("doc_id", "text", "w", g.alias("g"), n.alias("n"), (g % n).cast("int").alias("a"))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int").alias("p")
    ready = first.select("doc_id", "text", "w", "n", "a", period)
    again = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get(F.col("w"), F.col("a") + (i - F.col("a")) % F.col("p"))))
    found = periodic_runs(ready.select("doc_id", F.when(F.col("n").isNull(), F.col("text")).otherwise(F.array_join(again, " ")).alias("text")))
    longest = F.try_element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))), F.lit(1))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = found.select("doc_id", "runs", "collapsed", longest.alias("best"), lines.alias("lines"))
    length, period = -F.col("best.l"), F.col("best.p")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _periods_sql() -> str:
    """Candidate periods in SQL: how far away the same block of L words is next, L / 2 < period <= L, for L up to 8192."""
    levels = ["l1 AS (SELECT doc_id, i, dense_rank() OVER (PARTITION BY doc_id ORDER BY x) AS c FROM pos)"]
    found = []
    for k in range(1, 14):
        size, half = 2**k, 2 ** (k - 1)
        levels.append(f"""l{size} AS (
  SELECT doc_id, i, dense_rank() OVER (PARTITION BY doc_id ORDER BY c, f) AS c
  FROM (SELECT doc_id, i, c, coalesce(lead(c, {half}) OVER (PARTITION BY doc_id ORDER BY i), 0) AS f FROM l{half}))""")
        low = 1 if size == 2 else half + 1
        found.append(f"""SELECT DISTINCT doc_id, q FROM (
  SELECT doc_id, lead(i) OVER (PARTITION BY doc_id, c ORDER BY i) - i AS q FROM l{size}) WHERE q BETWEEN {low} AND {size}""")
    return ",\n".join([*levels, f"cand AS ({' UNION '.join(found)})"])


ORACLE["op13_periodic_runs"] = rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda acc, c: list_reduce(range(0, 8), lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END), xor(acc, c)),
      4294967295)) AS h
  FROM documents),
s AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS again, h // 10 AS g FROM d),
t AS (SELECT *, CASE WHEN again THEN g % n ELSE n END AS a, CASE WHEN again THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p FROM s),
pos AS (
  SELECT doc_id, i, w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS x
  FROM (SELECT doc_id, w, a, p, unnest(range(0, n)) AS i FROM t)),
{_periods_sql()},
same AS (
  SELECT doc_id, q, x.i, x.i - row_number() OVER (PARTITION BY doc_id, q ORDER BY x.i) AS island
  FROM cand JOIN l1 x USING (doc_id) JOIN l1 y USING (doc_id) WHERE y.i = x.i + q AND x.c = y.c),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM same GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, s, l, min(q) AS q FROM stretch GROUP BY doc_id, s, l),
per AS (
  SELECT doc_id, count(*) AS n_runs, arg_min({{'s': s, 'l': l, 'q': q}}, {{'l': -l, 's': s, 'q': q}}) AS b,
    string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, l, q) AS lines
  FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS collapsed FROM pos ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.l::BIGINT AS length, b.q::BIGINT AS period,
  (1000 * b.l // b.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id)"""
