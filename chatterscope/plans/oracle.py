"""The SQL counterpart of each query, for DuckDB over the same tables.

Statements are put together from shared WITH parts. ``sql`` collects the parts a statement needs.
"""

from __future__ import annotations

from chatterscope import resources as rs
from chatterscope.constants import (
    CUSTOM_STOPWORDS, EMOJI, FEEDS, IDIOMS, MAX_FEATURES, MIN_DOCS, STOP_ENTITIES, TOP_ENTITIES, TOP_KEYWORDS,
)
from chatterscope.fixtures import ENTITY_PHRASES, ENTITY_TEXTS, RULE_PHRASES
from chatterscope.functions.text import ENTITY_TOKEN, ENTITY_WORD, PUNCTUATION


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(v) for v in values)


def rounded(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def percent(part: str, whole: str) -> str:
    return rounded(f"CAST(100 AS DOUBLE) * CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE)", 1)


def mean(value: str) -> str:
    return (
        f"CAST(sum(CAST(round({value} * CAST(1000000 AS DOUBLE)) AS BIGINT)) AS DOUBLE)"
        f" / CAST(1000000 AS DOUBLE) / count({value})"
    )


def label(value: str, positive="'positive'", negative="'negative'", neutral="'neutral'") -> str:
    return (
        f"CASE WHEN {value} >= 0.05::DOUBLE THEN {positive} "
        f"WHEN {value} <= -0.05::DOUBLE THEN {negative} ELSE {neutral} END"
    )


def strip(value: str) -> str:
    return rf"regexp_replace({value}, '^\s+|\s+$', '', 'g')"


SHARES = ", ".join(
    percent(f"count(*) FILTER (label = '{name}')", "count(*)") + f" AS {name}_pct"
    for name in ("positive", "negative", "neutral")
)
SENTIMENT_TEXT = strip("coalesce(title, '') || '. ' || coalesce(body, '')")
POST_TEXT = "coalesce(title, '') || ' ' || coalesce(body, '')"
ITEM_KEY = "left(base64(unhex(sha256(url))), 20)"
PART_OF = "(CAST(('0x' || left(md5(post_id), 4)) AS BIGINT) % 4)"
ALL_STOPWORDS = [*CUSTOM_STOPWORDS, *rs.english_stopwords()]
SERIES = "PARTITION BY subreddit, keyword ORDER BY hour_bucket"
TREND_COLUMNS = f"""
    subreddit, keyword, hour_bucket, frequency,
    {rounded('avg_before', 2)} AS rolling_avg_7d,
    {rounded('frequency / nullif(avg_before, 0)', 2)} AS spike_ratio,
    coalesce(frequency > avg_before * 2.0::DOUBLE, FALSE) AS is_trending
"""
RANKING = "count DESC, contains(term, ' '), term"

PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, needs: str, body: str) -> None:
    PARTS[name] = (tuple(needs.split()), body)


part("lines", "", r"""
    SELECT *, split_part(text, chr(10), 1) AS first_line FROM documents JOIN events ON doc_id = event_id
""")
part("raw_posts", "lines", r"""
    SELECT 'd' || doc_id AS post_id, CASE WHEN doc_id % 5 = 0 THEN 'rss' ELSE 'reddit' END AS source,
           lang AS subreddit, first_line AS title,
           nullif(substr(text, length(first_line) + 2), '') AS body,
           CASE WHEN user_id % 10 <> 0 THEN 'u' || user_id END AS author,
           CAST(NULL AS VARCHAR) AS url, CAST(floor(value) AS INTEGER) AS score,
           CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS num_comments, ts AS created_utc
    FROM lines
""")
part("wide", "", """
    SELECT 'd' || event_id AS post_id, event_type AS subreddit, props AS title, ts AS created_utc FROM events
""")
part("compounds", "", """
    SELECT 'd' || event_id AS post_id,
           (CAST(round(value * 100) AS BIGINT) % 201 - 100) / 100.0::DOUBLE AS compound FROM events
""")
part("scores", "compounds", f"""
    SELECT *, greatest(compound, 0.0::DOUBLE) AS positive, greatest(-compound, 0.0::DOUBLE) AS negative,
           1.0::DOUBLE - abs(compound) AS neutral, {label('compound')} AS label FROM compounds
""")
part("trends", "", """
    SELECT event_type AS subreddit, 'u' || (user_id % 3) AS keyword,
           CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_bucket, count(*) AS frequency
    FROM events GROUP BY ALL
""")
part("entity_rows", "", r"""
    SELECT 'd' || event_id AS post_id, 'Brand ' || (user_id % 12) AS entity_text,
           CASE user_id % 4 WHEN 0 THEN 'ORG' WHEN 1 THEN 'PERSON' WHEN 2 THEN 'PRODUCT' ELSE 'GPE' END
             AS entity_type,
           CAST(CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) % 3 + 1 AS BIGINT) AS mention_count
    FROM events
""")
part("rolling", "trends", f"""
    SELECT *, avg(frequency) OVER ({SERIES} ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS avg_before
    FROM trends
""")
part("rolling_strict", "trends", f"""
    SELECT *, avg(frequency) OVER ({SERIES} RANGE BETWEEN INTERVAL 168 HOURS PRECEDING
              AND INTERVAL 1 HOUR PRECEDING) AS avg_before
    FROM trends
""")
part("tk", "rolling", f"SELECT {TREND_COLUMNS} FROM rolling")
part("tk_now", "trends", "SELECT max(hour_bucket) AS as_of FROM trends")
part("wide_now", "wide", "SELECT max(created_utc) AS as_of FROM wide")
part("by_hour", "wide scores", f"""
    SELECT CAST(date_trunc('hour', created_utc) AS TIMESTAMP) AS hour_bucket, subreddit,
           count(*) AS total_posts, {rounded(mean('compound'), 3)} AS avg_sentiment, {SHARES}
    FROM wide JOIN scores USING (post_id) GROUP BY 1, 2
""")
part("surge", "wide scores entity_rows", f"""
    SELECT entity_text, entity_type, subreddit, CAST(date_trunc('day', created_utc) AS TIMESTAMP)
             AS day_bucket, count(*) AS mention_count, {rounded(mean('compound'), 3)} AS avg_sentiment
    FROM entity_rows JOIN wide USING (post_id) JOIN scores USING (post_id)
    WHERE entity_type IN ('ORG', 'PERSON', 'PRODUCT') GROUP BY 1, 2, 3, 4
""")
part("days", "wide scores", f"""
    SELECT CAST(created_utc AS DATE) AS summary_date, subreddit, count(*) AS total_posts,
           {mean('compound')} AS avg_sentiment, {SHARES}
    FROM wide JOIN scores USING (post_id) GROUP BY 1, 2
""")
part("items", "", r"""
    SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
           [FEEDNAMES][CAST(page_id % 4 AS INTEGER) + 1] AS feed FROM pages
""".replace("FEEDNAMES", _list(name for name, _, _ in FEEDS)))
part("feeds", "", "SELECT * FROM (VALUES " + ", ".join(
    f"({_list((name, topic))})" for name, topic, _ in FEEDS) + ") t(feed, topic)")
part("feed_posts", "items feeds", f"""
    SELECT {ITEM_KEY} AS post_id, 'rss' AS source, topic AS subreddit, title,
           TIMESTAMP '2024-01-31 00:00:00' AS created_utc FROM items JOIN feeds USING (feed)
""")

# Keywords
part("cleaned", "raw_posts", rf"""
    SELECT post_id, coalesce(subreddit, 'unknown') AS subreddit,
           CAST(date_trunc('hour', created_utc) AS TIMESTAMP) AS hour_bucket,
           trim(regexp_replace(regexp_replace(lower({POST_TEXT}), 'https?://\S+', ' ', 'g'),
                               '[^a-z]+', ' ', 'g')) AS cleaned
    FROM raw_posts
""")
part("sizes", "cleaned", "SELECT subreddit, hour_bucket, count(*) AS posts FROM cleaned GROUP BY ALL")
part("all_words", "cleaned", """
    SELECT subreddit, hour_bucket, word, count(*) AS frequency
    FROM (SELECT subreddit, hour_bucket, unnest(string_split(cleaned, ' ')) AS word FROM cleaned)
    WHERE word <> '' GROUP BY ALL
""")
part("kept", "cleaned", f"""
    SELECT subreddit, hour_bucket, post_id, list_filter(string_split(cleaned, ' '),
             lambda w: length(w) >= 3 AND w NOT IN ({_list(ALL_STOPWORDS)})) AS k
    FROM cleaned
""")
part("tf", "kept", """
    SELECT subreddit, hour_bucket, post_id, term, count(*) AS tf
    FROM (SELECT subreddit, hour_bucket, post_id,
                 unnest(k || list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])) AS term
          FROM kept)
    GROUP BY ALL
""")
part("vocab", "tf sizes", f"""
    SELECT * FROM (
      SELECT *, ln((1 + posts) / CAST(1 + df AS DOUBLE)) + 1 AS idf,
             row_number() OVER (PARTITION BY subreddit, hour_bucket ORDER BY {RANKING}) AS rn
      FROM (SELECT subreddit, hour_bucket, term, CAST(sum(tf) AS BIGINT) AS count, count(*) AS df
            FROM tf GROUP BY ALL) JOIN sizes USING (subreddit, hour_bucket)
      WHERE posts >= {MIN_DOCS})
    WHERE rn <= {MAX_FEATURES}
""")
part("weights", "tf vocab", """
    SELECT subreddit, hour_bucket, post_id, term, posts, tf * idf AS w,
           sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY post_id, subreddit, hour_bucket)) AS norm
    FROM tf JOIN vocab USING (subreddit, hour_bucket, term)
""")
part("best", "weights", f"""
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY subreddit, hour_bucket ORDER BY score DESC, term) AS pos
      FROM (SELECT subreddit, hour_bucket, term, sum(CAST(round(w / norm * 1e9::DOUBLE) AS BIGINT)) AS score,
                   any_value(posts) AS posts
            FROM weights GROUP BY ALL))
    WHERE pos <= {TOP_KEYWORDS}
""")
part("tfidf", "best all_words", f"""
    SELECT subreddit, hour_bucket, term AS keyword, CAST(sum(frequency) AS BIGINT) AS frequency,
           {rounded('CAST(any_value(score) AS DOUBLE) / any_value(posts) / 1e9::DOUBLE', 4)} AS tfidf_score
    FROM (SELECT *, unnest(string_split(term, ' ')) AS word FROM best)
    JOIN all_words USING (subreddit, hour_bucket, word) GROUP BY subreddit, hour_bucket, term
""")
part("by_count", "all_words sizes", f"""
    SELECT subreddit, hour_bucket, word AS keyword, frequency, CAST(frequency AS DOUBLE) AS tfidf_score
    FROM (SELECT *, row_number() OVER (PARTITION BY subreddit, hour_bucket ORDER BY frequency DESC, word)
                 AS pos
          FROM all_words JOIN sizes USING (subreddit, hour_bucket)
          WHERE posts < {MIN_DOCS} AND length(word) >= 3 AND word NOT IN ({_list(CUSTOM_STOPWORDS)}))
    WHERE pos <= {TOP_KEYWORDS}
""")
part("keyword_rows", "tfidf by_count", """
    SELECT *, FALSE AS is_trending FROM (SELECT * FROM tfidf UNION ALL BY NAME SELECT * FROM by_count)
""")

# Sentiment of the rows of a part named "texts" (post_id, txt)
part("lexicon", "", "SELECT term, CAST(valence AS DOUBLE) AS valence FROM (VALUES " + ", ".join(
    f"({_text(r['term'])}, {r['valence']})" for r in rs.rows("lexicon")) + ") t(term, valence)")
part("modifiers", "", "SELECT term, kind, CAST(weight AS DOUBLE) AS weight FROM (VALUES " + ", ".join(
    f"({_list((r['term'], r['kind']))}, {r['weight']})" for r in rs.rows("modifiers"))
    + ") t(term, kind, weight)")
part("boosters", "modifiers", "SELECT * FROM modifiers WHERE kind = 'booster'")
part("rated", "lexicon boosters", "SELECT * FROM lexicon ANTI JOIN boosters USING (term)")
part("acting", "modifiers boosters lexicon", """
    SELECT * FROM boosters UNION ALL
    SELECT * FROM (SELECT * FROM modifiers WHERE kind IN ('negator', 'least')) ANTI JOIN lexicon USING (term)
""")


def shouted(word: str) -> str:
    return f"({word} = upper({word}) AND {word} <> lower({word}))"


def units(value: str) -> str:
    return f"CAST(round(({value}) * 1000000::DOUBLE) AS BIGINT)"


_P = _text(PUNCTUATION)
_SHOUTS = "(length(txt) - length(replace(txt, '!', '')))"
_ASKS = "(length(txt) - length(replace(txt, '?', '')))"
_EMPHASIS = (
    f"least({_SHOUTS}, 4) * 0.292::DOUBLE + CASE WHEN {_ASKS} <= 1 THEN 0::DOUBLE "
    f"WHEN {_ASKS} <= 3 THEN {_ASKS} * 0.18::DOUBLE ELSE 0.96::DOUBLE END"
)
part("tokens", "texts", rf"""
    SELECT post_id, coalesce({strip('txt')}, '') = '' AS blank,
           coalesce({units(_EMPHASIS)}, 0) AS emphasis,
           list_transform(regexp_split_to_array({strip("coalesce(txt, '')")}, '\s+'),
             lambda w: CASE WHEN length(trim(w, {_P})) > 2 THEN trim(w, {_P}) ELSE w END) AS t
    FROM texts
""")
part("facts", "tokens", f"""
    SELECT *, len(t) AS words, len(list_filter(t, lambda w: {shouted('w')})) AS shouted,
           coalesce(list_position(list_transform(t, lambda w: lower(w)), 'but'), 0) - 1 AS but_at
    FROM tokens
""")
part("word_rows", "facts", """
    SELECT post_id, blank, emphasis, words, shouted > 0 AND shouted < words AS mixed, but_at, i,
           t[i + 1] AS w, CASE WHEN i >= 1 THEN t[i] END AS p1, CASE WHEN i >= 2 THEN t[i - 1] END AS p2,
           CASE WHEN i >= 3 THEN t[i - 2] END AS p3
    FROM (SELECT *, unnest(range(0, len(t))) AS i FROM facts)
""")
part("rated_rows", "word_rows rated", """
    SELECT r.*, valence FROM word_rows r LEFT JOIN rated ON lower(w) = rated.term
""")
part("idioms", "", "SELECT string_split(term, ' ') AS g, CAST(valence AS DOUBLE) AS iv FROM (VALUES " + ", ".join(
    f"({_text(t)}, {v})" for t, v in IDIOMS) + ") t(term, valence)")
part("idiom_starts", "facts idioms", """
    SELECT post_id, i, max(len(g)) AS n, max_by(iv, len(g)) AS iv
    FROM (SELECT post_id, l, unnest(range(0, len(l))) AS i
          FROM (SELECT post_id, list_transform(t, lambda w: lower(w)) AS l FROM facts))
    JOIN idioms ON l[i + 1] = g[1] AND l[i + 1:i + len(g)] = g GROUP BY ALL
""")
RATED_WITH_IDIOMS = ("word_rows rated idiom_starts", """
    SELECT r.*, CASE WHEN NOT EXISTS (SELECT 1 FROM idiom_starts e
                                      WHERE e.post_id = r.post_id AND e.i < r.i AND r.i < e.i + e.n)
                     THEN coalesce(s.iv, valence) END AS valence
    FROM word_rows r LEFT JOIN rated ON lower(w) = rated.term
    LEFT JOIN idiom_starts s ON s.post_id = r.post_id AND s.i = r.i
""")
part("v0", "rated_rows", f"""
    SELECT * EXCLUDE (valence), valence + CASE WHEN mixed AND {shouted('w')} THEN sign(valence) * 0.733::DOUBLE
                                               ELSE 0::DOUBLE END AS v
    FROM rated_rows WHERE valence IS NOT NULL OR i = 0
""")
_LEAST = ", coalesce(kind = 'least' AND coalesce(lower(p2) NOT IN ('at', 'very'), TRUE), FALSE) AS least"
for _k, _damp in ((1, "1.0"), (2, "0.95"), (3, "0.9")):
    least = _LEAST if _k == 1 else ""
    part(f"v{_k}", f"v{_k - 1} acting", f"""
        SELECT r.* EXCLUDE (v), (v + CASE WHEN kind = 'booster' THEN (sign(v) * weight
                 + CASE WHEN mixed AND {shouted(f'p{_k}')} THEN sign(v) * 0.733::DOUBLE ELSE 0::DOUBLE END)
                 * {_damp}::DOUBLE ELSE 0::DOUBLE END)
               * CASE WHEN coalesce(kind = 'negator' OR contains(lower(p{_k}), 'n''t'), FALSE)
                      THEN -0.74::DOUBLE ELSE 1::DOUBLE END AS v{least}
        FROM v{_k - 1} r LEFT JOIN acting ON lower(p{_k}) = acting.term
    """)
part("hits", "v3", f"""
    SELECT post_id, blank, emphasis, words, {units('''v * CASE WHEN least THEN -0.74::DOUBLE ELSE 1::DOUBLE END * CASE WHEN but_at < 0 OR i = but_at THEN 1::DOUBLE
             WHEN i < but_at THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END''')} AS h FROM v3
""")
part("sums", "hits", """
    SELECT post_id, blank, emphasis, words, coalesce(CAST(sum(h) AS BIGINT), 0) AS total,
           coalesce(CAST(sum(h + 1000000) FILTER (h > 0) AS BIGINT), 0) AS pos,
           coalesce(CAST(sum(1000000 - h) FILTER (h < 0) AS BIGINT), 0) AS neg,
           count(*) FILTER (h <> 0) AS hits
    FROM hits GROUP BY ALL
""")
part("strength", "sums", """
    SELECT post_id, blank, CAST(total + sign(total) * emphasis AS DOUBLE) / 1000000::DOUBLE AS s,
           pos + CASE WHEN pos > neg THEN emphasis ELSE 0 END AS pos,
           neg + CASE WHEN neg > pos THEN emphasis ELSE 0 END AS neg,
           (words - hits) * 1000000 AS neu
    FROM sums
""")


def _score(name: str, blank_neutral: str) -> None:
    def share(column):
        return rounded(f"CAST({column} AS DOUBLE) / CAST(pos + neg + neu AS DOUBLE)", 3)

    part(f"{name}_rows", "strength", f"""
        SELECT post_id, CASE WHEN blank THEN 0::DOUBLE ELSE {rounded('s / sqrt(s * s + 15::DOUBLE)', 4)} END
                 AS compound,
               CASE WHEN blank THEN 0::DOUBLE ELSE {share('pos')} END AS positive,
               CASE WHEN blank THEN 0::DOUBLE ELSE {share('neg')} END AS negative,
               CASE WHEN blank THEN {blank_neutral}::DOUBLE ELSE {share('neu')} END AS neutral
        FROM strength
    """)
    part(name, f"{name}_rows", f"SELECT *, {label('compound')} AS label FROM {name}_rows")


_score("text_scores", "1")
_score("title_scores", "0")

# Entities of the rows of a part named "texts" (post_id, txt)
_WORD, _TOKEN = _text(ENTITY_WORD), _text(ENTITY_TOKEN)
part("gazetteer", "", rf"""
    SELECT DISTINCT regexp_extract_all(phrase, {_WORD}) AS g, entity_type,
           array_to_string(list_transform(regexp_extract_all(lower(trim(phrase)), '\p{{L}}+|[^\p{{L}}]+'),
             lambda x: upper(x[1]) || x[2:]), '') AS entity_text
    FROM (VALUES {', '.join(f"({_list((r['phrase'], r['entity_type']))})" for r in rs.rows('gazetteer'))})
         t(phrase, entity_type)
""")
part("spans", "texts gazetteer", f"""
    SELECT post_id, i AS s, i + len(g) AS e, entity_text, entity_type
    FROM (SELECT post_id, w, unnest(range(1, len(w) + 1)) AS i
          FROM (SELECT post_id, regexp_extract_all(coalesce(txt, ''), {_TOKEN}) AS w FROM texts))
    JOIN gazetteer ON w[i] = g[1] AND w[i:i + len(g) - 1] = g
""")
part("mentions", "spans", """
    SELECT * FROM spans a WHERE NOT EXISTS (
      SELECT 1 FROM spans b WHERE b.post_id = a.post_id AND b.s <= a.s AND b.e >= a.e
        AND b.e - b.s > a.e - a.s)
""")
part("mention_counts", "mentions", """
    SELECT post_id, entity_text, entity_type, count(*) AS mention_count FROM mentions GROUP BY ALL
""")
REPORTABLE = (
    f"length(entity_text) >= 2 AND lower(entity_text) NOT IN ({_list(STOP_ENTITIES)})"
    r" AND regexp_matches(entity_text, '\p{L}')"
)
part("found", "mention_counts", f"""
    SELECT post_id, entity_text, entity_type, mention_count FROM (
      SELECT *, row_number() OVER (PARTITION BY post_id
                  ORDER BY mention_count DESC, entity_text, entity_type) AS pos
      FROM mention_counts WHERE {REPORTABLE})
    WHERE pos <= {TOP_ENTITIES}
""")

POST_TEXTS = f"SELECT post_id, {POST_TEXT} AS txt FROM raw_posts"
SENTIMENT_TEXTS = f"SELECT post_id, {SENTIMENT_TEXT} AS txt FROM raw_posts"


def sql(needs: str, body: str, texts: tuple[str, str] | None = None, rated_rows: tuple[str, str] | None = None) -> str:
    """The statement with the parts it needs, each after the parts it is made of."""
    parts = dict(PARTS)
    if rated_rows:
        parts["rated_rows"] = (tuple(rated_rows[0].split()), rated_rows[1])
    if texts:
        parts["texts"] = (tuple(texts[0].split()), texts[1])
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for needed in parts[name][0]:
                add(needed)
            order.append(name)

    for name in needs.split():
        add(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({parts[n][1]})" for n in order) + "\n" + body




def cleanup(rows: str, text: str) -> str:
    return rf"""
        SELECT * FROM (
          SELECT post_id, array_to_string(list_transform(
                   regexp_extract_all(lower({strip(text)}), '\p{{L}}+|[^\p{{L}}]+'),
                   lambda x: CASE WHEN x[1] = 'ß' THEN 'Ss' ELSE upper(x[1]) END || x[2:]), '') AS entity_text
          FROM {rows})
        WHERE {REPORTABLE}"""


ON_POSTS = ("raw_posts", POST_TEXTS)
ON_SENTIMENT = ("raw_posts", SENTIMENT_TEXTS)


def spelled(value: str) -> str:
    for symbol, name in EMOJI:
        value = rf"regexp_replace({value}, '{symbol}\x{{FE0F}}?', ' {name} ', 'g')"
    return value


def chosen(values: list[str]) -> str:
    return f"([{_list(values)}])[CAST(('0x' || left(md5(post_id), 6)) AS BIGINT) % {len(values)} + 1]"


def _phrased(phrases: list[str], text: str) -> tuple[str, str]:
    return "raw_posts", f"""
    SELECT post_id, {text} AS txt
    FROM (SELECT post_id, title || ' ' || {chosen(phrases)} AS title, body FROM raw_posts)"""


ON_SPELLED = ("raw_posts", f"SELECT post_id, {spelled(SENTIMENT_TEXT)} AS txt FROM raw_posts")
ON_RULES = _phrased(RULE_PHRASES, spelled(SENTIMENT_TEXT))
EPOCH = "epoch(date_trunc('second', created_utc))"

ORACLE: dict[str, str] = {
    # Sources
    "read_posts": sql("raw_posts", f"""
        SELECT * EXCLUDE (created_utc), CAST({EPOCH} AS DOUBLE) AS created_epoch FROM raw_posts"""),
    "normalize_post": sql("raw_posts", """
        SELECT post_id, source, subreddit, title, nullif(body, '') AS body,
               coalesce(author, '[deleted]') AS author, url, score, num_comments,
               CAST(date_trunc('second', created_utc) AS TIMESTAMP) AS created_utc FROM raw_posts"""),
    "select_listing": sql("raw_posts", """
        SELECT post_id, subreddit, score, created_utc, listing, rank FROM (
          SELECT *, 'new' AS listing, row_number() OVER (PARTITION BY subreddit
                   ORDER BY created_utc DESC, post_id) AS rank FROM raw_posts
          UNION ALL
          SELECT *, 'top' AS listing, row_number() OVER (PARTITION BY subreddit
                   ORDER BY score DESC, post_id) AS rank FROM raw_posts
          UNION ALL
          SELECT *, 'hot' AS listing, row_number() OVER (PARTITION BY subreddit
                   ORDER BY log10(greatest(abs(score), 1)) * sign(score) + epoch(date_trunc('second', created_utc)) / 45000 DESC,
                   post_id) AS rank FROM raw_posts)
        WHERE rank <= 100"""),
    "read_targets": sql("raw_posts", """
        SELECT post_id, subreddit, created_utc, score, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, post_id) AS rank
          FROM raw_posts WHERE subreddit IN ('en', 'fr'))
        WHERE rank <= 50"""),
    "read_rss": sql("feed_posts", "SELECT * REPLACE (trim(title) AS title) FROM feed_posts"),
    "rss_key": sql("items", f"""
        SELECT url AS link, {ITEM_KEY} AS post_id, left(url, 20) AS legacy_key FROM items"""),
    "feed_topic_join": sql("items feeds", """
        SELECT feed, topic, url AS link FROM items LEFT JOIN feeds USING (feed)"""),
    "rss_pipeline": sql("feed_posts title_scores", """
        SELECT post_id, subreddit, trim(title) AS title, created_utc, compound, positive, negative, neutral, label
        FROM feed_posts JOIN title_scores USING (post_id)""",
                        ("items", f"SELECT {ITEM_KEY} AS post_id, {spelled('trim(title)')} AS txt FROM items"), RATED_WITH_IDIOMS),
    "rss_stream": sql("feed_posts title_scores", f"""
        SELECT post_id, subreddit, trim(feed_posts.title) AS title,
               CASE WHEN page_id % 6 = 5 THEN feed_posts.created_utc
                    ELSE TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(page_id AS INTEGER)) END AS created_utc,
               compound, positive, negative, neutral, label
        FROM feed_posts JOIN title_scores USING (post_id)
        JOIN (SELECT page_id, {ITEM_KEY} AS post_id FROM pages) USING (post_id)""",
                      ("items", f"SELECT {ITEM_KEY} AS post_id, {spelled('trim(title)')} AS txt FROM items"), RATED_WITH_IDIOMS),
    "isolated_sources": sql("raw_posts items", """
        SELECT 'json' AS kind, post_id AS key, NULL AS reason FROM raw_posts
        UNION ALL SELECT 'json', NULL, 'does not parse' FROM pages WHERE page_id % 7 = 0
        UNION ALL SELECT 'parquet', post_id, NULL FROM raw_posts
        UNION ALL SELECT 'parquet', NULL, 'no readable parquet file'
        UNION ALL SELECT 'xml', url, NULL FROM items
        UNION ALL SELECT 'xml', NULL, 'does not parse'"""),
    "quarantine_rows": """
        SELECT 'title is null' AS violations, count(*) AS rows FROM pages WHERE page_id % 5 = 0
        UNION ALL SELECT 'does not parse', count(*) FROM pages WHERE page_id % 7 = 0""",
    "scan_tables": sql("wide", """
        SELECT CAST(created_utc AS DATE) AS dt, subreddit, count(*) AS posts FROM wide GROUP BY ALL"""),
    "union_sources": sql("raw_posts feed_posts", """
        SELECT post_id, source, subreddit, title, body, created_utc FROM raw_posts UNION ALL
        SELECT post_id, source, subreddit, title, NULL, created_utc FROM feed_posts"""),
    # Sinks: an append that skips known keys ends in all keys once
    "append_new_posts": sql("raw_posts", "SELECT post_id, subreddit, title, created_utc FROM raw_posts"),
    "append_sentiment": sql("scores", "SELECT * FROM scores"),
    "append_entities": sql("entity_rows", "SELECT * FROM entity_rows"),
    "write_keyword_trends": sql("trends", "SELECT * FROM trends"),
    "upsert_daily_summary": sql("wide scores wide_now", f"""
        SELECT CAST(created_utc AS DATE) AS summary_date, subreddit, count(*) AS total_posts,
               {mean('compound')} AS avg_sentiment, {SHARES}
        FROM wide JOIN scores USING (post_id), wide_now
        WHERE CAST(created_utc AS DATE) = CAST(as_of AS DATE) OR {PART_OF} <= 2 GROUP BY 1, 2"""),
    "write_metrics": sql("scores", f"""
        SELECT count(*) FILTER ({PART_OF} >= 2) AS attempted, count(*) FILTER ({PART_OF} > 2) AS inserted,
               count(*) AS stored FROM scores"""),
    "anti_existing": sql("scores", f"SELECT * FROM scores WHERE {PART_OF} > 2"),
    "validate_contract": r"""
        SELECT url AS post_id, 0 AS score, array_to_string(list_filter([
                 CASE WHEN title IS NULL THEN 'title is null' END,
                 CASE WHEN length(url) > 20 THEN 'post_id is longer than 20' END],
                 lambda x: x IS NOT NULL), '; ') AS violations
        FROM (SELECT url, CASE WHEN page_id % 5 <> 0 THEN regexp_extract(html, '<title>([^<]*)</title>', 1) END AS title
              FROM pages)""",
    "fk_semi": sql("scores", """
        SELECT post_id, label, CASE WHEN post_id IN (SELECT 'd' || doc_id FROM documents)
               THEN 'valid' ELSE 'orphan' END AS state FROM scores"""),
    "delete_posts_cascade": sql("wide scores entity_rows", """
        SELECT name, post_id, item FROM wide JOIN (
          SELECT 'raw_posts' AS name, post_id, subreddit AS item FROM wide
          UNION ALL SELECT 'sentiment_scores', post_id, label FROM scores
          UNION ALL SELECT 'extracted_entities', post_id, entity_text FROM entity_rows) USING (post_id)
        WHERE subreddit <> 'error'"""),
    # Projections and filters
    "combined_text": sql("raw_posts", f"""
        SELECT post_id, {SENTIMENT_TEXT} AS sentiment_text, {POST_TEXT} AS post_text FROM raw_posts"""),
    "recent_window": sql("wide_now", """
        SELECT wide.* FROM wide, wide_now WHERE created_utc >= as_of - INTERVAL 24 HOURS"""),
    "today_only": sql("wide_now", """
        SELECT wide.* FROM wide, wide_now WHERE CAST(created_utc AS DATE) = CAST(as_of AS DATE)"""),
    "entity_type_in": sql("entity_rows", """
        SELECT * FROM entity_rows WHERE entity_type IN ('ORG', 'PERSON', 'PRODUCT')"""),
    "is_trending_only": sql("tk", "SELECT * FROM tk WHERE is_trending"),
    "slicers": sql("tk", """
        SELECT * FROM tk WHERE keyword IN ('u0', 'u2')
        AND hour_bucket BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 23:00:00'"""),
    "empty_text_guard": sql("raw_posts", f"""
        SELECT post_id, 0::DOUBLE AS compound, 0::DOUBLE AS positive, 0::DOUBLE AS negative,
               1::DOUBLE AS neutral, 'neutral' AS label
        FROM raw_posts WHERE coalesce({strip('body')}, '') = ''"""),
    # Joins and summaries
    "posts_join_sentiment": sql("wide scores", """
        SELECT * EXCLUDE (title) FROM wide JOIN scores USING (post_id)"""),
    "entities_posts_sentiment": sql("wide scores entity_rows", """
        SELECT post_id, entity_text, entity_type, mention_count, subreddit, created_utc, compound, label
        FROM entity_rows JOIN wide USING (post_id) JOIN scores USING (post_id)"""),
    "sentiment_by_hour": sql("by_hour", "SELECT * FROM by_hour"),
    "label_pct": sql("wide scores", f"""
        SELECT subreddit, {SHARES} FROM wide JOIN scores USING (post_id) GROUP BY subreddit"""),
    "entity_surge": sql("surge", "SELECT * FROM surge"),
    "sentiment_gauge": sql("wide_now scores", f"""
        SELECT label, count(*) AS count, {percent('count(*)', 'sum(count(*)) OVER ()')} AS percentage
        FROM scores JOIN wide USING (post_id), wide_now
        WHERE created_utc >= as_of - INTERVAL 24 HOURS GROUP BY label"""),
    "pct_of_total": sql("wide", f"""
        SELECT subreddit, count(*) AS count, {percent('count(*)', 'sum(count(*)) OVER ()')} AS percentage
        FROM wide GROUP BY subreddit"""),
    "top_entities": sql("surge wide_now", f"""
        SELECT entity_text, entity_type, CAST(sum(mention_count) AS BIGINT) AS total_mentions,
               {rounded(mean('avg_sentiment'), 3)} AS avg_sentiment,
               count(DISTINCT subreddit) AS subreddit_spread
        FROM surge, wide_now WHERE day_bucket >= as_of - INTERVAL 7 DAYS
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 50"""),
    "daily_summary": sql("days", "SELECT * FROM days"),
    "daily_top_terms": sql("days entity_rows trends", """
        , e AS (SELECT *, row_number() OVER (PARTITION BY summary_date, subreddit ORDER BY n DESC, entity_text) AS pos
                FROM (SELECT CAST(created_utc AS DATE) AS summary_date, subreddit, entity_text,
                             sum(mention_count) AS n
                      FROM entity_rows JOIN wide USING (post_id) GROUP BY ALL)),
          k AS (SELECT *, row_number() OVER (PARTITION BY summary_date, subreddit ORDER BY n DESC, keyword) AS pos
                FROM (SELECT CAST(hour_bucket AS DATE) AS summary_date, subreddit, keyword,
                             sum(frequency) AS n FROM trends GROUP BY ALL))
        SELECT days.summary_date, days.subreddit, total_posts, entity_text AS top_entity,
               keyword AS top_keyword
        FROM days LEFT JOIN (SELECT * FROM e WHERE pos = 1) e USING (summary_date, subreddit)
        LEFT JOIN (SELECT * FROM k WHERE pos = 1) k USING (summary_date, subreddit)""".lstrip()),
    "kpi_cards": sql("by_hour", f"""
        SELECT {rounded(mean('avg_sentiment'), 3)} AS avg_sentiment,
               {rounded(mean('positive_pct'), 1)} AS positive_pct,
               {rounded(mean('negative_pct'), 1)} AS negative_pct,
               CAST(sum(total_posts) AS BIGINT) AS total_posts FROM by_hour"""),
    "label_donut": sql("scores", f"""
        SELECT {label('compound')} AS sentiment, count(*) AS posts FROM scores GROUP BY 1"""),
    "sentiment_line": sql("by_hour wide_now", """
        SELECT hour_bucket, subreddit, avg_sentiment, positive_pct, negative_pct, total_posts
        FROM by_hour, wide_now WHERE hour_bucket >= as_of - INTERVAL 7 DAYS"""),
    "entity_table": sql("surge", f"""
        SELECT *, CASE WHEN avg_sentiment < 0 THEN 'red' WHEN avg_sentiment > 0 THEN 'green' END AS colour
        FROM (SELECT entity_text, entity_type, CAST(sum(mention_count) AS BIGINT) AS total_mentions,
                     {rounded(mean('avg_sentiment'), 3)} AS avg_sentiment FROM surge GROUP BY 1, 2)"""),
    "entity_type_breakdown": sql("surge", """
        SELECT entity_type, subreddit, count(*) AS count FROM surge GROUP BY 1, 2"""),
    # Trends
    "trending_keywords": sql("tk", "SELECT * FROM tk"),
    "trending_keywords_strict_time": sql("rolling_strict", f"SELECT {TREND_COLUMNS} FROM rolling_strict"),
    "rolling_avg_7d": sql("rolling", "SELECT * EXCLUDE (avg_before), avg_before AS rolling_avg_7d FROM rolling"),
    "cumulative_total": sql("trends", f"""
        SELECT *, CAST(sum(frequency) OVER ({SERIES} ROWS BETWEEN 168 PRECEDING AND CURRENT ROW) AS BIGINT)
                 AS cumulative_total FROM trends"""),
    "top_keywords_now": sql("tk tk_now", """
        SELECT subreddit, keyword, CAST(sum(frequency) AS BIGINT) AS total_mentions,
               max(spike_ratio) AS peak_spike_ratio, bool_or(is_trending) AS currently_trending
        FROM tk, tk_now WHERE hour_bucket >= as_of - INTERVAL 6 HOURS
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 30"""),
    "trend_alerts": sql("tk tk_now", """
        SELECT subreddit, keyword, max(frequency) AS peak_hourly_frequency,
               max(rolling_avg_7d) AS normal_avg, max(spike_ratio) AS spike_ratio,
               min(hour_bucket) AS first_detected
        FROM tk, tk_now WHERE is_trending AND hour_bucket >= as_of - INTERVAL 48 HOURS GROUP BY 1, 2"""),
    "alert_bands": sql("tk", """
        SELECT subreddit, keyword, hour_bucket, spike_ratio,
               CASE WHEN spike_ratio > 5 THEN 'red' WHEN spike_ratio >= 3 THEN 'orange'
                    WHEN spike_ratio >= 2 THEN 'yellow' END AS band FROM tk"""),
    "trending_word_cloud": sql("tk", """
        SELECT keyword, CAST(sum(frequency) AS BIGINT) AS total_frequency FROM tk WHERE is_trending
        GROUP BY 1"""),
    "top15_keywords": sql("trends", """
        SELECT subreddit || '/' || keyword AS keyword, CAST(sum(frequency) AS BIGINT) AS total_frequency
        FROM trends GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""),
    "keyword_timeline": sql("tk tk_now", """
        SELECT subreddit, keyword, hour_bucket, frequency, spike_ratio, is_trending FROM tk, tk_now
        WHERE hour_bucket >= as_of - INTERVAL 7 DAYS AND keyword = 'u1'"""),
    "trend_view_order": sql("tk", """
        SELECT *, row_number() OVER (ORDER BY hour_bucket DESC, spike_ratio DESC NULLS LAST, subreddit, keyword)
                  AS position FROM tk"""),
    "timeline_order": sql("tk", """
        SELECT subreddit, keyword, hour_bucket, frequency, spike_ratio, is_trending, row_number() OVER (
                 ORDER BY hour_bucket DESC, spike_ratio DESC NULLS FIRST, subreddit, keyword) AS position
        FROM tk WHERE hour_bucket >= TIMESTAMP '2024-01-03 00:00:00' - INTERVAL 7 DAYS"""),
    "display_orders": sql("by_hour wide_now scores", """
        SELECT item, value, tile, position FROM (
          SELECT 'gauge' AS tile, label AS item, n AS value, row_number() OVER (ORDER BY n DESC, label) AS position
          FROM (SELECT label, count(*) AS n FROM scores JOIN wide USING (post_id), wide_now
                WHERE created_utc >= as_of - INTERVAL 24 HOURS GROUP BY label)
          UNION ALL
          SELECT 'line', subreddit, total_posts, row_number() OVER (ORDER BY hour_bucket, subreddit)
          FROM by_hour, wide_now WHERE hour_bucket >= as_of - INTERVAL 7 DAYS)"""),
    "top_n_per_group": sql("trends", """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subreddit
                         ORDER BY frequency DESC, hour_bucket DESC, keyword) AS rank FROM trends)
        WHERE rank <= 20"""),
    # Texts
    "clean_text": sql("cleaned", "SELECT post_id, cleaned FROM cleaned"),
    "post_buckets": sql("sizes", f"SELECT *, posts >= {MIN_DOCS} AS uses_tfidf FROM sizes"),
    "word_frequency": sql("all_words", "SELECT * FROM all_words"),
    "tfidf_keywords": sql("tfidf", "SELECT * FROM tfidf"),
    "frequency_keywords": sql("by_count", "SELECT * FROM by_count"),
    "keyword_trends": sql("keyword_rows", "SELECT * FROM keyword_rows"),
    "lexicon_sentiment": sql("text_scores", "SELECT * FROM text_scores", ON_SPELLED, RATED_WITH_IDIOMS),
    "sentiment_rules": sql("text_scores", "SELECT * FROM text_scores", ON_RULES, RATED_WITH_IDIOMS),
    "flatten_sentiment": sql("scores", "SELECT * FROM scores"),
    "rss_title_sentiment": sql("title_scores", "SELECT * FROM title_scores",
                               ("items", f"SELECT {ITEM_KEY} AS post_id, title AS txt FROM items")),
    "entity_counts": sql("mention_counts", "SELECT * FROM mention_counts", ON_POSTS),
    "gazetteer_entities": sql("found", "SELECT * FROM found",
                              ("", "SELECT 'd' || doc_id AS post_id, text AS txt FROM documents")),
    "lexicon_sentiment_repeats": sql("text_scores", "SELECT * FROM text_scores", ON_SENTIMENT),
    "entity_repeats": sql("found", "SELECT * FROM found", ON_POSTS),
    "extract_from_posts": sql("found", "SELECT * FROM found", ON_POSTS),
    "entity_cleanup": sql("raw_posts", cleanup("raw_posts", "title")),
    "entity_rules": sql("found", "SELECT * FROM found", _phrased(ENTITY_PHRASES, POST_TEXT)),
    "entity_cleanup_rules": sql("raw_posts", cleanup(
        f"(SELECT post_id, unnest([{chosen(ENTITY_TEXTS)}, title]) AS t FROM raw_posts)", "t")),
    "custom_scorer": sql("raw_posts", f"""
        SELECT post_id, share AS compound, share AS positive, 0::DOUBLE AS negative,
               round(1 - share, 3) AS neutral, 'neutral' AS label
        FROM (SELECT post_id, round((length(t) - length(replace(t, '!', ''))) / greatest(length(t), 1)::DOUBLE, 3)
                     AS share FROM (SELECT post_id, {POST_TEXT} AS t FROM raw_posts))"""),
    # Streams
    "hourly_pipeline": sql("raw_posts text_scores found keyword_rows", f"""
        , e AS (SELECT *, row_number() OVER (PARTITION BY summary_date, subreddit ORDER BY n DESC, entity_text) AS pos
                FROM (SELECT CAST(created_utc AS DATE) AS summary_date, subreddit, entity_text,
                             sum(mention_count) AS n
                      FROM found JOIN raw_posts USING (post_id) GROUP BY ALL)),
          k AS (SELECT *, row_number() OVER (PARTITION BY summary_date, subreddit ORDER BY n DESC, keyword) AS pos
                FROM (SELECT CAST(hour_bucket AS DATE) AS summary_date, subreddit, keyword,
                             sum(frequency) AS n FROM keyword_rows GROUP BY ALL)),
          days AS (SELECT CAST(created_utc AS DATE) AS summary_date, subreddit, count(*) AS total_posts,
                          {mean('compound')} AS avg_sentiment, {SHARES}
                   FROM raw_posts JOIN text_scores USING (post_id) GROUP BY 1, 2)
        SELECT days.*, entity_text AS top_entity, keyword AS top_keyword
        FROM days LEFT JOIN (SELECT * FROM e WHERE pos = 1) e USING (summary_date, subreddit)
        LEFT JOIN (SELECT * FROM k WHERE pos = 1) k USING (summary_date, subreddit)""".lstrip(), ON_SENTIMENT),
    "stream_dedup_posts": sql("raw_posts", """
        SELECT post_id, subreddit, CAST(date_trunc('second', created_utc) AS TIMESTAMP) AS created_utc
        FROM raw_posts"""),
    "stream_hourly_sentiment_closed": sql("by_hour wide_now", """
        SELECT by_hour.* FROM by_hour, wide_now
        WHERE hour_bucket + INTERVAL 1 HOUR <= date_trunc('millisecond', as_of) - INTERVAL 2 HOURS"""),
    "stream_metrics": sql("raw_posts", """
        , t AS (SELECT date_trunc('second', created_utc) AS made FROM raw_posts),
          m AS (SELECT avg(epoch(made)) AS middle FROM t),
          a AS (SELECT count(*) AS n, max(made) - INTERVAL 2 HOURS AS mark FROM t, m WHERE epoch(made) >= middle)
        SELECT 1::BIGINT AS batch, n AS attempted, n AS inserted, 0::BIGINT AS dropped_late FROM a
        UNION ALL
        SELECT 2, count(*), 0, count(*) FILTER (made <= mark) FROM t, a""".lstrip()),
    "late_posts": sql("keyword_rows", "SELECT * FROM keyword_rows"),
}
ORACLE["stream_dedup_exact"] = ORACLE["stream_dedup_posts"]
ORACLE["stream_dedup"] = ORACLE["stream_dedup_posts"]
ORACLE["stream_hourly_sentiment"] = ORACLE["stream_hourly_sentiment_closed"]
