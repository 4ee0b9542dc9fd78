"""DuckDB SQL of the corpus queries that SQL can express, with rules and limits as literals of its own."""

from __future__ import annotations

_URL = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', {})"
_SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TOPK = """
WITH fit AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM fit AS q JOIN fit AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

_FILTER = f"""
WITH cut AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<title>(.*?)</title>', 1) AS title,
        {_SMALL.format(_URL.format(1))} AS host, {_URL.format(2)} AS path,
        regexp_extract(coalesce(url, ''), '(?s)^[^?#]*\\?([^#]*)', 1) AS asked
    FROM pages
), keyed AS (
    SELECT page_id, host, path, title,
        CASE WHEN host = '' THEN '' ELSE
            regexp_replace(regexp_replace(host, '^(www|m)\\.', ''), ':(80|443)$', '')
            || regexp_replace(regexp_replace(path, '\\.html?$', ''), '/+$', '')
            || CASE WHEN len(parts) > 0 THEN '?' || array_to_string(list_sort(parts), '&') ELSE '' END END AS form
    FROM (SELECT *, list_filter(string_split(asked, '&'), lambda x: x <> ''
              AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid)(=.*)?$')) AS parts FROM cut)
), bad AS (
    SELECT form, title FROM keyed WHERE len(list_intersect(string_split(host, '.'),
        ['casino-win', 'free-bets', 'ads-track', 'spam-farm', 'cheap-pills', 'adult-x'])) > 0
), listed AS (
    SELECT form FROM bad WHERE form <> ''
    UNION SELECT form FROM keyed WHERE form <> '' AND title <> '' AND title IN (SELECT title FROM bad)
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
    FROM keyed
)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
         WHEN rule IS NOT NULL THEN 'block'
         WHEN form IN (SELECT form FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""

_HOSTS = """
WITH texts AS (
    SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS text FROM documents
), cut AS (
    SELECT n, doc_id, source, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM texts
), spots AS (
    SELECT n, words, unnest(range(1, len(words) - 3)) AS spot FROM cut WHERE len(words) >= 5
), windows AS (
    SELECT n, spot, count(*) OVER (PARTITION BY n, list_slice(words, spot, spot + 4)) AS times FROM spots
), covered AS (
    SELECT n, count(DISTINCT spot + step) AS n_repeat_words
    FROM windows, (SELECT unnest(range(0, 5)) AS step) WHERE times > 1 GROUP BY n
), figures AS (
    SELECT n, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM cut LEFT JOIN covered USING (n)
), rules AS (
    SELECT source, unnest([n_words < 10, 100 * n_repeat_words > 20 * n_words, 10 * n_symbols > word_chars]) AS failed,
        unnest([1, 2, 3]) AS rule
    FROM figures
), counts AS (
    SELECT rule, source, count(*) AS docs, sum(failed::INT) AS fails FROM rules GROUP BY ALL
), pooled AS (
    SELECT rule, sum(fails) / sum(docs) AS mean, count(*) AS hosts, avg(fails / docs) AS own,
        avg((fails / docs) ** 2) AS squares, avg(1 / docs) AS inverse FROM counts GROUP BY rule
), priors AS (
    SELECT rule, mean, least(greatest(CASE WHEN squares - own * own - mean * (1 - mean) * inverse > 0
        THEN mean * (1 - mean) / (squares - own * own - mean * (1 - mean) * inverse) - 1 ELSE 1000 END, 1), 1000) AS strength
    FROM pooled
), hosts AS (
    SELECT source, max((fails + mean * strength) / (docs + strength)) > 0.5 AS refused
    FROM counts JOIN priors USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT refused AS kept
FROM figures JOIN hosts ON figures.source IS NOT DISTINCT FROM hosts.source"""

_REPEATS = """
WITH texts AS (
    SELECT row_number() OVER () AS n, doc_id, encode(coalesce(text, '')) AS raw FROM documents
), strings AS (
    SELECT n, spot, md5_number(hex(array_slice(raw, spot, spot + 199))) AS string
    FROM (SELECT n, raw, unnest(range(1, octet_length(raw) - 198)) AS spot FROM texts WHERE octet_length(raw) >= 200)
), marks AS (
    SELECT n, spot, count(*) OVER (PARTITION BY string) > 1 AS twice FROM strings
), runs AS (
    SELECT n, min(spot) AS first, max(stop) AS stop FROM (
        SELECT *, sum(opens) OVER (PARTITION BY n ORDER BY spot) AS run FROM (
            SELECT n, spot, spot + 199 AS stop,
                CAST(coalesce(lag(spot) OVER (PARTITION BY n ORDER BY spot) + 200 < spot, true) AS INT) AS opens
            FROM marks WHERE twice))
    GROUP BY n, run
), gaps AS (
    SELECT n, first, stop, coalesce(lag(stop) OVER (PARTITION BY n ORDER BY first), 0) + 1 AS since FROM runs
), pieces AS (
    SELECT n, CAST(sum(stop - first + 1) AS BIGINT) AS gone, count(*) AS spans, max(stop) AS last,
        list({'since': since, 'till': first - 1} ORDER BY first) AS kept
    FROM gaps GROUP BY n
)
SELECT doc_id, octet_length(raw) AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
    sha256(CASE WHEN gone IS NULL THEN raw ELSE unhex(
        list_aggregate(list_transform(kept, lambda k: hex(array_slice(raw, k.since, k.till))), 'string_agg', '')
        || hex(array_slice(raw, last + 1, octet_length(raw)))) END) AS kept_sha256
FROM texts LEFT JOIN pieces USING (n)"""

ANSWERS = {"op1_topk": _TOPK, "op3_url_filter": _FILTER, "op8_host_rules": _HOSTS, "op12_suffix_dedup": _REPEATS}
