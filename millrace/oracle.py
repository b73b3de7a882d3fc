"""DuckDB SQL for the queries of the catalog, written independently of the Spark plans."""

from __future__ import annotations

# Parameters of the queries and fixed values, spelled out: a wrong one over there shows here.
TARGET = "fr"
SEQ_LEN, BATCH_ROWS = 512, 100
DAY, NOW = 86_400, 1_706_745_600
MAX_PAGES, PAGE_CAP, MAX_QUEUE = 200, 10, 3_000
DROP_TAGS = ("script", "style", "noscript", "svg", "header", "footer", "nav", "form", "button", "input")
NATIVE_ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "nbsp": "\xa0", "copy": "©", "middot": "·", "amp": "&"}
LATIN = "A-Za-z"
SENTENCE_MARKS = "።.!?፧"
WHITESPACE = (
    r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0 "
    r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
TRACKING_KEYS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid")

_KEEP_NAV = [t for t in DROP_TAGS if t != "nav"]
_STAMP = "2024-02-01T00:00:00.000000+00:00"


def _norm(text: str) -> str:
    return f"trim(regexp_replace({text}, '[{WHITESPACE}]+', ' ', 'g'))"


def _sentences(source: str, keys: str, text: str = "text") -> str:
    """DuckDB has no look-behind: mark the cuts with a character that cannot occur."""
    lead = f"{keys}, " if keys else ""
    return f"""
        SELECT {lead}CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS sentence
        FROM (SELECT {lead}string_split(regexp_replace(t, '([{SENTENCE_MARKS}]) ', '\\1' || chr(31), 'g'), chr(31)) AS l
              FROM (SELECT {lead}{_norm(text)} AS t FROM ({source})) WHERE t <> '')"""


_DOC = _sentences("SELECT * FROM documents", "doc_id")
_RATIO = (
    "CASE WHEN length(regexp_replace(sentence, '\\P{L}+', '', 'g')) > 0 THEN "
    f"length(regexp_replace(sentence, '[^{LATIN}]+', '', 'g')) / "
    "length(regexp_replace(sentence, '\\P{L}+', '', 'g')) ELSE 0.0 END"
)


def _first(source: str, order: str, columns: str) -> str:
    return f"""
        SELECT {columns} FROM (SELECT *, sha256(sentence) AS hash FROM ({source}))
        QUALIFY row_number() OVER (PARTITION BY hash ORDER BY {order}) = 1"""


def _canonical(source: str, keys: str, url: str = "url") -> str:
    tracking = ", ".join(f"'{k}'" for k in TRACKING_KEYS)
    return f"""
        SELECT {keys}, CASE WHEN scheme = '' THEN '' ELSE
          scheme || '://' || authority ||
          CASE WHEN path IN ('', '/') THEN '/' ELSE regexp_replace(path, '/$', '') END ||
          CASE WHEN query = '' THEN '' ELSE '?' || query END END AS url
        FROM (SELECT {keys},
            lower(regexp_extract(u, '(?i)^(https?):', 1)) AS scheme,
            lower(regexp_extract(u, '(?i)^https?://([^/?#]*)', 1)) AS authority,
            regexp_replace(regexp_extract(u, '(?i)^https?:(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '') AS path,
            array_to_string(list_transform(list_sort(list_filter(list_transform(list_filter(
              string_split(regexp_extract(u, '^[^?#]*[?]([^#]*)', 1), '&'),
              lambda p: regexp_matches(p, '^[^=]*=.')),
              lambda p: {{'k': url_decode(replace(regexp_extract(p, '^([^=]*)=', 1), '+', '%20')),
                          'v': url_decode(replace(regexp_extract(p, '^[^=]*=(.*)', 1), '+', '%20'))}}),
              lambda s: lower(s.k) NOT IN ({tracking}))),
              lambda s: replace(url_encode(s.k) || '=' || url_encode(s.v), '%20', '+')), '&') AS query
          FROM (SELECT {keys}, trim({url}) AS u FROM ({source})))"""


_URLS = _canonical("SELECT * FROM pages", "page_id")
_DOMAIN = "regexp_extract(url, '//([^/?#]*)', 1)"


def _dropped(tags: list[str] | tuple[str, ...]) -> str:
    html = "html"
    for tag in tags:
        html = f"regexp_replace({html}, '(?is)<{tag}(?:\\s[^>]*)?>.*?</{tag}\\s*>', ' ', 'g')"
    return f"regexp_replace({html}, '(?s)<!--.*?-->', ' ', 'g')"


def _page_text(tags: list[str] | tuple[str, ...] = DROP_TAGS, keys: str = "page_id, url") -> str:
    text = f"regexp_extract({_dropped(tags)}, '(?is)<body(?:\\s[^>]*)?>(.*)', 1)"
    text = f"regexp_replace({text}, '(?s)<[A-Za-z/!?][^>]*>', ' ', 'g')"
    for name, character in NATIVE_ENTITIES.items():
        text = f"regexp_replace({text}, '&{name};?', '{character}', 'g')"
    return f"SELECT {keys}, {_norm(text)} AS text FROM pages"


def _page_links() -> str:
    hrefs = f"""
        SELECT page_id, url, unnest(range(len(l))) AS pos, unnest(l) AS href
        FROM (SELECT page_id, url, regexp_extract_all({_dropped(_KEEP_NAV)}, '(?is)<a\\s[^>]*?href="([^"]*)"', 1) AS l
              FROM pages)"""
    absolute = f"""
        SELECT page_id, CAST(pos AS INTEGER) AS pos,
               regexp_extract(url, '^[a-zA-Z]+://[^/?#]*') || trim(href) AS link
        FROM ({hrefs}) WHERE trim(href) <> ''"""
    return f"SELECT page_id, pos, url AS link FROM ({_canonical(absolute, 'page_id, pos', 'link')}) WHERE url <> ''"


_PAGE = _sentences(_page_text(), "page_id, url")
_LINKS = _page_links()


def _grams(source: str, keys: str, text: str) -> str:
    return f"""
        SELECT {keys}, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram
        FROM (SELECT {keys}, string_split({text}, '') AS c FROM ({source}))"""


_COUNTS = f"""
    SELECT lang AS label, gram, count(*) AS n
    FROM ({_grams('SELECT * FROM documents', 'lang', 'text')}) GROUP BY ALL"""


def _profile_ctes() -> str:
    return f"""counts AS MATERIALIZED ({_COUNTS}),
      size AS (SELECT count(DISTINCT gram) AS v FROM counts),
      totals AS (SELECT label, sum(n) AS total, any_value(v) AS v FROM counts, size GROUP BY label),
      floors AS (SELECT label, CAST(round(ln(1 / (total + v)) * 1000000) AS BIGINT) AS floor FROM totals),
      profile AS (SELECT label, gram, CAST(round(ln((n + 1) / (total + v)) * 1000000) AS BIGINT) AS score
                  FROM counts JOIN totals USING (label))"""


def _predict(source: str, keys: str, text: str) -> str:
    """Best label of each row: floor for every n-gram plus the gain of the known ones."""
    return f"""
      SELECT {keys}, label AS lang, CAST(total AS BIGINT) AS score FROM (
        SELECT {keys}, label, n * floor + coalesce(gain, 0) AS total
        FROM (SELECT {keys}, length({text}) - 2 AS n FROM ({source}) WHERE length({text}) > 2)
        CROSS JOIN floors
        LEFT JOIN (SELECT {keys}, label, sum(score - floor) AS gain
                   FROM ({_grams(source, keys, text)}) JOIN profile USING (gram) JOIN floors USING (label)
                   GROUP BY ALL) USING ({keys}, label))
      QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY total DESC, label) = 1"""


def _target(source: str, keys: str, columns: str) -> str:
    """Body of a query (after ``WITH``) for sentences that pass all three tests."""
    return f"""{_profile_ctes()},
      kept AS MATERIALIZED (SELECT * FROM ({source}) WHERE length(sentence) >= 20 AND {_RATIO} >= 0.4),
      best AS ({_predict('SELECT * FROM kept', keys, 'sentence')})
      SELECT {columns} FROM kept JOIN best USING ({keys}) WHERE lang = '{TARGET}'"""


_EVENTS = "SELECT event_id, user_id, epoch_us(ts) // 1000000 AS sec FROM events"
_VISITED = f"SELECT CAST(user_id AS VARCHAR) AS url, arg_max(sec, event_id) AS last_visited FROM ({_EVENTS}) GROUP BY 1"
_GATE = f"""
    WITH RECURSIVE firsts AS (SELECT user_id, sec, min(event_id) AS event_id FROM ({_EVENTS}) GROUP BY 1, 2),
      passed AS (
        SELECT user_id, min(sec) AS sec FROM firsts GROUP BY 1
        UNION ALL
        SELECT p.user_id, min(f.sec) AS sec FROM passed p JOIN firsts f
          ON f.user_id = p.user_id AND f.sec >= p.sec + {DAY} GROUP BY p.user_id)
    SELECT event_id, user_id, sec FROM firsts JOIN passed USING (user_id, sec)"""

_HEX = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, hex(encode(text)) AS h FROM documents"


def _ids_md5(h: str) -> str:
    """Hash of the bytes written as numbers."""
    return f"md5(array_to_string(list_transform(regexp_extract_all({h}, '..'), lambda b: CAST('0x' || b AS INTEGER)), ' '))"


def _digest(keys: str, source: str) -> str:
    return f"SELECT {keys}, CAST(length(h) // 2 AS BIGINT) AS n, {_ids_md5('h')} AS ids_md5 FROM ({source})"


def _blocks(rows: str, keys: str) -> str:
    """``rows`` gives the keys of a batch, ``i`` and ``h``."""
    width = 2 * SEQ_LEN
    return f"""
        SELECT {keys}, block_id, substr(s, block_id * {width} + 1, {width}) AS h
        FROM (SELECT {keys}, s, unnest(range(length(s) // {width})) AS block_id
              FROM (SELECT {keys}, string_agg(h, '' ORDER BY i) AS s FROM ({rows}) GROUP BY ALL))"""


def _shards(count: int) -> str:
    """Contiguous shards, the first ones a row longer where the rows do not divide evenly."""
    return f"""
        SELECT shard, (i - shard * size - least(shard, longer)) // {BATCH_ROWS} AS batch_id, i, h
        FROM (SELECT *, CAST(CASE WHEN i < longer * (size + 1) THEN i // (size + 1)
                             ELSE longer + (i - longer * (size + 1)) // size END AS INTEGER) AS shard
              FROM ({_HEX}), (SELECT count(*) // {count} AS size, count(*) % {count} AS longer FROM documents))"""


def _ruled(once: str, french: str) -> str:
    """CTEs of one crawl cycle under all rules: the first admitted pages, and what is queued then."""
    inside = f"""EXISTS (
        SELECT 1 FROM names WHERE {_DOMAIN} = base OR ends_with({_DOMAIN}, '.' || base))"""
    permitted = """NOT contains(url, '//blog.') AND (
        NOT regexp_matches(url, '^https?://[^/]*/de/') OR regexp_matches(url, '^https?://[^/]*/de/1'))"""
    return f"""
      once AS MATERIALIZED ({once}),
      names AS (SELECT DISTINCT regexp_replace(domain, '^(m|www|blog)[.]', '') AS base FROM ({french})),
      admitted AS MATERIALIZED (
        SELECT * FROM once WHERE url <> '' AND NOT contains(url, '/es/') AND {permitted} AND {inside}
        ORDER BY page_id LIMIT {PAGE_CAP}),
      remainder AS (SELECT url, page_id FROM once WHERE page_id > (SELECT max(page_id) FROM admitted)),
      linked AS (
        SELECT url, page_id, pos FROM (SELECT link AS url, page_id, pos FROM ({_LINKS}))
        WHERE page_id IN (SELECT page_id FROM admitted) AND url NOT IN (SELECT url FROM once) AND {inside}
        QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id, pos) = 1),
      room AS (SELECT (SELECT count(*) FROM once) - (SELECT count(*) FROM remainder) AS n),
      queue AS (
        SELECT url, CAST(0 AS INTEGER) AS depth, page_id, CAST(0 AS INTEGER) AS pos FROM remainder
        UNION ALL
        SELECT url, CAST(1 AS INTEGER), page_id, pos FROM linked
        QUALIFY row_number() OVER (ORDER BY page_id, pos) <= (SELECT n FROM room))"""


def _feed() -> str:
    """Six rounds of a Feistel network over row numbers, walked on while a number is beyond the rows."""
    digits = "CAST('0x' || substr(md5('42:' || n || ':{}'), 1, 7) AS BIGINT) + 1"
    tossed = "((({v} % 2147483647 * f + s + epoch * e) % 2147483647) * (({v} % 2147483647 * f + s + epoch * e) % 2147483647) % 2147483647)"
    return f"""
      WITH RECURSIVE size AS (
        SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM documents
      ), factors AS (
        SELECT n, a, (n + a - 1) // a AS b FROM size
      ), rounds AS (
        SELECT n AS round, {digits.format('a')} AS f, {digits.format('b')} AS s, {digits.format('c')} AS e FROM range(6) t(n)
      ), walk AS (
        SELECT doc_id, epoch, 0::BIGINT AS round, place % a AS low, place // a AS high
        FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents),
             (SELECT unnest([0, 1]) AS epoch), factors
        UNION ALL
        SELECT doc_id, epoch, CASE WHEN w.round < 6 THEN w.round + 1 ELSE 0 END,
          CASE WHEN w.round = 6 THEN (high * a + low) % a WHEN w.round % 2 = 0 THEN (low + {tossed.format(v='high')}) % a ELSE low END,
          CASE WHEN w.round = 6 THEN (high * a + low) // a WHEN w.round % 2 = 1 THEN (high + {tossed.format(v='low')}) % b ELSE high END
        FROM walk w LEFT JOIN rounds r ON r.round = w.round, factors
        WHERE w.round < 6 OR high * a + low >= n
      )
      SELECT CAST(epoch AS INTEGER) AS epoch, doc_id, high * a + low AS feed_key FROM walk, factors
      WHERE round = 6 AND high * a + low < n AND (epoch = 0 OR high * a + low < n // 2)"""


def sql() -> dict[str, str]:
    """Query name to SQL."""
    french = f"SELECT DISTINCT {_DOMAIN} AS domain FROM ({_URLS}) WHERE contains(url, '/fr/')"
    batches = f"SELECT i // {BATCH_ROWS} AS batch_id, i, h FROM ({_HEX})"
    blocks = _digest("batch_id, block_id", _blocks(batches, "batch_id"))
    short = f"SELECT doc_id, i, substr(h, 1, {2 * SEQ_LEN}) AS h FROM ({_HEX})"
    long_latin = f"length(sentence) >= 20 AND {_RATIO} >= 0.4"
    predicted = f"WITH {_profile_ctes()} {_predict('SELECT doc_id, text FROM documents', 'doc_id', 'text')}"
    links = f"SELECT DISTINCT link AS url FROM ({_LINKS})"
    once = f"SELECT url, min(page_id) AS page_id FROM ({_URLS}) GROUP BY url"
    nav_text = _sentences(
        f"SELECT p.page_id, o.url, text FROM ({_page_text(_KEEP_NAV)}) p JOIN ({once}) o USING (page_id)",
        "page_id, url",
    )
    ruled = _ruled(once, french)
    levels = f"""
        WITH once AS ({once}),
          seeds AS (SELECT url, page_id FROM once WHERE page_id IN (SELECT min(page_id) FROM once GROUP BY {_DOMAIN})),
          linked AS (SELECT DISTINCT link AS url FROM ({_LINKS}) JOIN seeds USING (page_id))
        SELECT url, CAST(0 AS INTEGER) AS depth FROM seeds
        UNION ALL
        SELECT url, CAST(1 AS INTEGER) AS depth FROM linked
        WHERE url NOT IN (SELECT url FROM seeds) AND EXISTS (
          SELECT 1 FROM (SELECT DISTINCT {_DOMAIN} AS base FROM once) WHERE {_DOMAIN} = base OR ends_with({_DOMAIN}, '.' || base))"""
    queries = {
        "norm_text": f"SELECT doc_id, {_norm('text')} AS norm FROM documents",
        "split_sentences": _DOC,
        "min_length": f"SELECT * FROM ({_DOC}) WHERE length(sentence) >= 20",
        "sentence_hash": f"SELECT doc_id, pos, sha256(sentence) AS hash FROM ({_DOC})",
        "script_ratio": f"SELECT doc_id, pos, round({_RATIO}, 6) AS ratio FROM ({_DOC})",
        "script_filter": f"SELECT * FROM ({_DOC}) WHERE {_RATIO} >= 0.95",
        "dedup_first": _first(_DOC, "doc_id, pos", "doc_id, pos, sentence, hash"),
        "anti_seen": f"""
            SELECT hash, sentence FROM ({_first(_DOC, 'doc_id, pos', 'hash, sentence')})
            WHERE sentence NOT IN (SELECT sentence FROM ({_sentences('SELECT * FROM conversations', 'conv_id')}))""",
        "langid_fit": _COUNTS,
        "langid_profile": f"""
            WITH {_profile_ctes()} SELECT label, gram, score FROM profile
            UNION ALL SELECT label, '' AS gram, floor AS score FROM floors""",
        "langid_predict": predicted,
        "langid_predict_join": predicted,
        "target_filter": f"WITH {_target(_DOC, 'doc_id, pos', 'doc_id, pos, sentence')}",
        "page_source": "SELECT page_id, url FROM pages WHERE NOT starts_with(url, 'http:') AND NOT ends_with(url, '.html')",
        "page_archive": f"""
            SELECT url, CAST(200 AS INTEGER) AS status, 'text/html' AS content_type, sha256(coalesce(html, '')) AS html_sha256,
                   CAST({NOW} AS BIGINT) AS fetched FROM pages""",
        "page_text": f"SELECT page_id, text FROM ({_page_text()})",
        "page_sentences": f"SELECT page_id, pos, sentence FROM ({_PAGE})",
        "gather_pages": f"""
            WITH target AS ({"WITH " + _target(_PAGE, 'page_id, pos', 'page_id, pos, url, sentence')})
            SELECT sha256(sentence) AS hash, sentence AS text, url, CAST({NOW} AS BIGINT) AS timestamp FROM target
            QUALIFY row_number() OVER (PARTITION BY sentence ORDER BY page_id, pos) = 1""",
        "extract_links": _LINKS,
        "canonical_url": _URLS,
        "url_domain": f"SELECT page_id, {_DOMAIN} AS domain FROM ({_URLS})",
        "distinct_urls": links,
        "seed_domains": f"SELECT DISTINCT {_DOMAIN} AS domain FROM ({_URLS})",
        "allow_all": f"SELECT page_id, url FROM ({_URLS}) WHERE {_DOMAIN} <> ''",
        "allow_exact": f"SELECT page_id, url FROM ({_URLS}) WHERE {_DOMAIN} IN ({french})",
        "allow_subdomain": f"""
            WITH names AS (SELECT DISTINCT regexp_replace(domain, '^(m|www|blog)[.]', '') AS base FROM ({french}))
            SELECT page_id, url FROM ({_URLS}) u WHERE EXISTS (
              SELECT 1 FROM names WHERE {_DOMAIN} = base OR ends_with({_DOMAIN}, '.' || base))""",
        "same_or_subdomain": f"""
            SELECT page_id, ends_with('.' || {_DOMAIN}, '.example.com') AS in_com, true AS itself FROM ({_URLS})""",
        "robots_filter": f"""
            SELECT page_id, url FROM ({_URLS}) WHERE NOT contains(url, '//blog.')
            AND (NOT regexp_matches(url, '^https?://[^/]*/de/') OR regexp_matches(url, '^https?://[^/]*/de/1'))""",
        "visited_upsert": _VISITED,
        "revisit_due": f"""
            SELECT event_id, url FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS url FROM events)
            JOIN ({_VISITED}) USING (url) WHERE {NOW} - last_visited >= {2 * DAY}""",
        "revisit_gate": _GATE,
        "not_queued": f"SELECT url FROM ({links}) WHERE NOT regexp_matches(url, '/[a-m][^/]*$')",
        "depth_cap": levels,
        "page_cap": f"""
            SELECT url, CAST(0 AS INTEGER) AS depth, page_id AS ord FROM ({_URLS}) WHERE url <> ''
            ORDER BY page_id LIMIT {MAX_PAGES}""",
        "queue_cap": f"SELECT * FROM ({_LINKS}) ORDER BY page_id, pos LIMIT {MAX_QUEUE}",
        "cycle_report": f"""
            WITH {ruled}, written AS ({_first(
                f"SELECT * FROM ({nav_text}) WHERE page_id IN (SELECT page_id FROM admitted) AND {long_latin}",
                'page_id, pos', 'hash')})
            SELECT (SELECT count(*) FROM admitted) AS pages, (SELECT count(*) FROM written) AS sentences_written,
                   (SELECT count(*) FROM queue) AS queue, true AS timed""",
        "frontier_queue": f"WITH {ruled} SELECT url, depth, row_number() OVER (ORDER BY depth, page_id, pos) - 1 AS ord FROM queue",
        "frontier_ruled_visits": f"WITH {ruled} SELECT url, CAST({NOW} AS BIGINT) AS last_visited FROM admitted",
        "frontier_visits": f"""
            SELECT url, CAST({NOW} AS BIGINT) AS last_visited
            FROM (SELECT url FROM ({_URLS})
                  UNION SELECT link FROM ({_LINKS}) WHERE page_id IN (SELECT page_id FROM ({once})))""",
        "frontier_sentences": _first(
            f"SELECT * FROM ({nav_text}) WHERE {long_latin}", "page_id, pos", "sentence AS text, url, hash"
        ),
        "text_column": "SELECT text FROM conversations",
        "read_parquet": "SELECT doc_id, text FROM documents",
        "read_text_column": "SELECT CASE WHEN doc_id % 10 = 9 THEN CAST(n_chars AS VARCHAR) END AS text FROM documents",
        "list_files": "SELECT DISTINCT lang FROM documents",
        "read_seeds": f"SELECT url, CAST(0 AS INTEGER) AS depth FROM ({_URLS}) WHERE url <> ''",
        "crawl_state": """
            SELECT CAST(user_id AS VARCHAR) AS url, max(CAST(floor(epoch(ts)) AS BIGINT)) AS last_visited
            FROM events GROUP BY user_id""",
        "reseed": f"""
            SELECT url, CAST(0 AS INTEGER) AS depth, min(page_id) AS ord
            FROM ({_URLS}) WHERE url <> '' GROUP BY url""",
        "allow_mixed_case": f"SELECT page_id, url FROM ({_URLS}) WHERE {_DOMAIN} IN ({french})",
        "state_resume": f"SELECT DISTINCT sentence AS text FROM ({_PAGE}) WHERE {long_latin}",
        "read_jsonl": "SELECT doc_id, text, lang FROM documents",
        "read_csv": "SELECT CAST(doc_id AS INTEGER) AS doc_id, text, lang FROM documents",
        "read_txt": "SELECT unnest(string_split(text, chr(10))) AS text FROM documents",
        "read_dataset": "SELECT conv_id, turn, text FROM conversations",
        "write_sentences": f"SELECT sentence AS text, 'doc:' || doc_id AS url, '{_STAMP}' AS timestamp FROM ({_DOC})",
        "tokenize_bytes": _digest("doc_id", _HEX),
        "truncate_tokens": f"SELECT *, n AS ones FROM ({_digest('doc_id', short)})",
        "exact_length": f"SELECT doc_id FROM ({short}) WHERE length(h) = {2 * SEQ_LEN}",
        "pack_blocks": blocks,
        "pack_shards": _digest("shard, batch_id, block_id", _blocks(_shards(3), "shard, batch_id")),
        "build_corpus": blocks,
        "corpus_dataset": blocks,
        "corpus_stream": _digest("doc_id", short),
        "collate": f"""
            SELECT batch_id, i AS row_idx, kept, widest AS n, {_ids_md5('p')} AS ids_md5,
                   len(list_filter(regexp_extract_all(p, '..'), lambda b: b = '0A')) AS ignored
            FROM (SELECT *, h || repeat('0A', CAST(widest - kept AS INTEGER)) AS p
                  FROM (SELECT i // 16 AS batch_id, i, h, CAST(length(h) // 2 AS BIGINT) AS kept,
                               CAST(max(length(h) // 2) OVER (PARTITION BY i // 16) AS BIGINT) AS widest
                        FROM ({short})))""",
        "shuffle_feed": _feed(),
        "stream_distinct": f"SELECT DISTINCT sha256(sentence) AS hash, sentence FROM ({_DOC})",
        "stream_gather": f"""
            SELECT sentence AS text, url, '{_STAMP}' AS timestamp
            FROM ({_first(f'SELECT * FROM ({_PAGE}) WHERE {long_latin}', 'page_id, pos', 'sentence, url')})""",
    }
    same = {
        "page_archive_stream": "page_archive",
        "visit_buckets": "crawl_state",
        "page_text_native": "page_text",
        "extract_links_native": "extract_links",
        "tokenize_bytes_native": "tokenize_bytes",
        "stream_tokens": "tokenize_bytes",
        "stream_gate": "revisit_gate",
        "stream_gate_table": "revisit_gate",
    }
    queries |= {name: queries[other] for name, other in same.items()}
    queries["stream_tokens"] = _digest("doc_id", short)
    return queries
