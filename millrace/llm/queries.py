"""One query for each operator of this package, over whole tables, and SQL twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import anntree, crf, decontaminate, hyperlang, minhash, packing, parsing, repair, toxicity, urlfilter, warc, whitening, wrapper
from millrace.llm.shared import held_out
from millrace.operators.sizing import workspace

TOKENIZERS = None  # a folder of vocabulary files; None: those of the installed package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark, sf_dir):
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=2)


def op2_wrapper(spark, sf_dir):
    found = wrapper.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op3_hyperlang(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", "lang", held_out("doc_id", 4, 2).alias("held_out"))
    prototypes = hyperlang.train(docs.where("NOT held_out"))
    return hyperlang.predict(docs, prototypes).select("doc_id", "held_out", "lang_pred", "score")


def op4_nnls_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZERS)


def op5_arc_to_warc(spark, sf_dir):
    """Pages to ARC files, those to WARC files, and these read back."""
    path, number = workspace(spark), "X-Page-Id"
    warc.write_arc(warc.page_records(_table(spark, sf_dir, "pages"), number), f"{path}-arc")
    warc.arc_to_warc(warc.read_arc(spark, f"{path}-arc"), number, f"{path}-warc")
    return warc.read_warc(spark, f"{path}-warc", number).select(
        F.col("key").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op6_kmeans_tree(spark, sf_dir):
    rows = anntree.usable(_table(spark, sf_dir, "embeddings"))
    return anntree.neighbours(rows, rows.where("id % 20 = 0"), 20)


def op7_noisy_or(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id", 5, 0).alias("held_out"))
    labels = _table(spark, sf_dir, "labels")
    model = toxicity.train(docs.where("NOT held_out"), labels.where(~held_out("doc_id", 5, 0)))
    return toxicity.score(docs, model).select(
        "doc_id", "held_out", "score", "predicted", "worst_start", "worst_end", "worst_score"
    )


def op8_winnowing(spark, sf_dir):
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.decontaminate(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op9_url_filter(spark, sf_dir):
    model = urlfilter.train(urlfilter.labelled_urls())
    return urlfilter.judge(_table(spark, sf_dir, "pages"), URL_RULES, model)


def op10_crf(spark, sf_dir):
    found = crf.find(_table(spark, sf_dir, "documents"))
    joined = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )

    def many(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(many, crf.KINDS),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
    )


def op11_parsing(spark, sf_dir):
    return parsing.compare_with_next(_table(spark, sf_dir, "documents"))


def op12_repair(spark, sf_dir):
    rows = repair.damage(_table(spark, sf_dir, "conversations"))
    found = repair.summarize(rows)
    hashed = repair.digests(repair.repair(rows, found)).withColumnRenamed("conv_id", "_conv_id")
    joined = found.join(hashed, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left")
    return joined.select(*found.columns, F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_whitening(spark, sf_dir):
    rows = whitening.quantized(_table(spark, sf_dir, "embeddings"))
    model = whitening.fit(rows)
    shares = F.array(*(F.lit(float(e / model.trace)) for e in model.eigenvalues)).cast("array<double>")
    return whitening.project(rows, model).select(
        "vec_id", F.posexplode("whitened").alias("at", "whitened"), "deviation"
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )


QUERIES = {q.__name__: q for q in (op1_minhash, op2_wrapper, op3_hyperlang, op4_nnls_packing, op5_arc_to_warc, op6_kmeans_tree, op7_noisy_or, op8_winnowing, op9_url_filter, op10_crf, op11_parsing, op12_repair, op13_whitening)}

_OP1 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
        ELSE w END) AS s
    FROM words
), shingles AS (
    SELECT doc_id, unnest(s) AS g FROM sets
), ids AS (
    SELECT doc_id, dense_rank() OVER (ORDER BY g) AS g FROM shingles
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM ids x JOIN ids y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common
    JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
    WHERE 100 * n >= 80 * (len(p.s) + len(q.s) - n)
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT doc_id AS start, doc_id AS node FROM documents
    UNION
    SELECT start, b FROM reached JOIN both_ways ON node = a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least_id AS component_id, doc_id = least_id AS kept
FROM sets JOIN (SELECT start, min(node) AS least_id FROM reached GROUP BY start) ON start = doc_id
"""

_OP8 = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n,
        unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda i: array_to_string(w[i : i + 9], ' '))) AS g
    FROM items WHERE len(w) > 0
), doc_windows AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w
    FROM docs, (SELECT DISTINCT n FROM item_windows)
), hits AS (
    SELECT doc_id, i, d.n, item_id
    FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM doc_windows) d
    JOIN item_windows t ON t.g = d.g AND t.n = d.n
), places AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(DISTINCT item_id::VARCHAR) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

_OP5 = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)
"""

_OP12 = r"""
WITH RECURSIVE crc_bits AS (
    SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM crc_bits WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8
), source AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
), keyed AS (
    SELECT source.*, xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(key, ''), lambda x: unicode(x)::BIGINT)),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295::BIGINT) % 20 AS fault
    FROM source, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE WHEN fault = 0 THEN 0 WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
    FROM keyed
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || ':' || text), copy) AS pos
    FROM damaged
), judged AS (
    SELECT *, left(role, 1) AS initial, CASE
        WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated'
        ELSE '' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier
    FROM placed
), after(source, initial, target) AS (
    VALUES ('e', 's', 's'), ('e', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
), inserts(source, target, cost, letters) AS (
    VALUES ('e', 'e', 0, ''), ('e', 'u', 2, 'I'), ('e', 'a', 4, 'II'), ('s', 's', 0, ''), ('s', 'u', 2, 'I'),
        ('s', 'a', 4, 'II'), ('u', 'u', 0, ''), ('u', 'a', 2, 'I'), ('a', 'a', 0, ''), ('a', 'u', 2, 'I')
), ways AS (
    SELECT conv_id, pos, source, target, 0 AS cost, 'K' AS letters
    FROM judged JOIN after USING (initial) WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL
    SELECT conv_id, pos, source, target, 2, 'R'
    FROM judged, after WHERE fault NOT IN ('blank', 'duplicate') AND after.initial <> 's'
    UNION ALL
    SELECT conv_id, pos, s, s, 3, 'D' FROM judged, (SELECT unnest(['e', 's', 'u', 'a']) AS s)
), moves AS (
    SELECT w.conv_id, w.pos, i.source, w.target, i.letters || w.letters AS letters,
        i.cost + w.cost + CASE WHEN j.fault = 'truncated' AND w.letters <> 'D' THEN 1 ELSE 0 END AS cost
    FROM ways w JOIN inserts i ON i.target = w.source
    JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.pos = w.pos
), best AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS pos, 'e' AS state, 0::BIGINT AS cost, '' AS audit FROM judged
    UNION ALL
    SELECT conv_id, pos, state, substr(least_way, 1, 12)::BIGINT, substr(least_way, 13)
    FROM (SELECT b.conv_id, m.pos, m.target AS state,
              min(lpad((b.cost + m.cost)::VARCHAR, 12, '0') || b.audit || m.letters) AS least_way
          FROM best b JOIN moves m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.pos = b.pos + 1 AND m.source = b.state
          GROUP BY b.conv_id, m.pos, m.target)
), ends AS (
    SELECT conv_id, max(pos) AS pos FROM placed GROUP BY conv_id
), solved AS (
    SELECT b.conv_id, min(lpad((b.cost + i.cost)::VARCHAR, 12, '0') || b.audit || i.letters) AS least_way
    FROM best b JOIN ends e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.pos = b.pos
    JOIN inserts i ON i.source = b.state WHERE i.target IN ('e', 'a') GROUP BY b.conv_id
), audits AS (
    SELECT conv_id, substr(least_way, 1, 12)::BIGINT AS cost, substr(least_way, 13) AS audit FROM solved
), letters AS (
    SELECT conv_id, letter, n,
        sum(CASE WHEN letter = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY n) AS pos
    FROM (SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(length(audit))) AS n FROM audits)
), stayed AS (
    SELECT l.conv_id, l.letter, l.n, p.role, CASE WHEN l.letter = 'I' THEN '' ELSE p.text END AS text,
        row_number() OVER (PARTITION BY l.conv_id ORDER BY l.n) AS k,
        min(CASE WHEN l.letter = 'K' AND left(p.role, 1) = 's' THEN 1 ELSE 0 END * -1)
            OVER (PARTITION BY l.conv_id) AS shift
    FROM letters l LEFT JOIN placed p ON p.conv_id IS NOT DISTINCT FROM l.conv_id AND p.pos = l.pos
    WHERE l.letter IN ('K', 'R', 'I')
), lines AS (
    SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role
        WHEN (k + shift) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY n) AS repaired
    FROM stayed GROUP BY conv_id
), totals AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
    coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
    sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLES = {"op12_repair": _OP12, "op1_minhash": _OP1, "op5_arc_to_warc": _OP5, "op8_winnowing": _OP8}
