"""Named queries over the test tables, one for each operator. Each runs over whole tables."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.functions import text as T
from millrace.functions import tokens as K
from millrace.functions import urls as U
from millrace.operators import admission, history, langid, packing, robots, visits
from millrace.operators.dedup import first_sentences, with_hash
from millrace.operators.filters import target_sentences
from millrace.operators.ordering import index_by_file, index_by_key
from millrace.operators.pages import explode_links, explode_sentences, extract
from millrace.operators.sizing import first_rows, spread, store, workspace
from millrace.plans import corpus, frontier, gather
from millrace.sources import archive, files, output
from millrace.sources import pages as pages_source
from millrace.sources.pages import accepted_pages, seed_frontier, with_response
from millrace.streaming import gate, runs

TARGET = "fr"
SEQ_LEN = 512
BATCH_ROWS = 100
DAY = 86_400
NOW = 1_706_745_600  # 2024-02-01, just after the last event
SEED = 42
PAGE_CAP = 10  # binds on the smallest tables
SECONDS = "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) AS sec"
# Every link of the test pages is inside <nav>, which the default removes.
KEEP_NAV = tuple(t for t in H.DROP_TAGS if t != "nav")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _documents(spark, sf_dir):
    return _table(spark, sf_dir, "documents")


def _pages(spark, sf_dir):
    return _table(spark, sf_dir, "pages")


def _events(spark, sf_dir):
    return _table(spark, sf_dir, "events").selectExpr("event_id", "user_id", SECONDS)


def _doc_sentences(spark, sf_dir):
    return explode_sentences(_documents(spark, sf_dir).select("doc_id", "text"))


def _model(spark, sf_dir):
    return langid.profile(langid.fit(_documents(spark, sf_dir)))


def _page_urls(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", U.canonical_url(F.col("url")).alias("url"))


def _page_links(spark, sf_dir):
    return explode_links(extract(_pages(spark, sf_dir), KEEP_NAV)).select("page_id", "pos", "link")


# --- text -----------------------------------------------------------------


def norm_text(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", T.normalize_text(F.col("text")).alias("norm"))


def split_sentences(spark, sf_dir):
    return _doc_sentences(spark, sf_dir)


def min_length(spark, sf_dir):
    return _doc_sentences(spark, sf_dir).where(T.long_enough(F.col("sentence")))


def sentence_hash(spark, sf_dir):
    return with_hash(_doc_sentences(spark, sf_dir), "sentence").select("doc_id", "pos", "hash")


def script_ratio(spark, sf_dir):
    ratio = F.round(T.script_ratio(F.col("sentence"), T.LATIN), 6)
    return _doc_sentences(spark, sf_dir).select("doc_id", "pos", ratio.alias("ratio"))


def script_filter(spark, sf_dir):
    return _doc_sentences(spark, sf_dir).where(T.in_script(F.col("sentence"), T.LATIN, 0.95))


def dedup_first(spark, sf_dir):
    return first_sentences(_doc_sentences(spark, sf_dir), ["doc_id", "pos"], text="sentence")


def anti_seen(spark, sf_dir):
    seen = with_hash(explode_sentences(_table(spark, sf_dir, "conversations").select("text")), "sentence")
    stored = history.history(store(history.in_ranges(seen.select("hash").distinct())))
    new = first_sentences(_doc_sentences(spark, sf_dir), ["doc_id", "pos"], stored, "sentence")
    return new.select("hash", "sentence")


# --- language -------------------------------------------------------------


def langid_fit(spark, sf_dir):
    return langid.fit(_documents(spark, sf_dir))


def langid_profile(spark, sf_dir):
    return _model(spark, sf_dir)


def langid_predict(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return langid.predict(docs, _model(spark, sf_dir), ["doc_id"]).select("doc_id", "lang", "score")


def langid_predict_join(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    scored = langid.predict(docs, _model(spark, sf_dir), ["doc_id"], max_rows=0)
    return scored.select("doc_id", "lang", "score")


def target_filter(spark, sf_dir):
    return target_sentences(
        _doc_sentences(spark, sf_dir), ["doc_id", "pos"], TARGET, _model(spark, sf_dir), script=T.LATIN
    )


# --- pages ----------------------------------------------------------------


def page_source(spark, sf_dir):
    pages = with_response(_pages(spark, sf_dir))
    # No table has responses, so they follow from the page: http gives an error, .html plain text.
    answered = pages.withColumn("status", F.when(F.col("url").startswith("http:"), 404).otherwise(200))
    kind = F.when(F.col("url").endswith(".html"), "text/plain").otherwise("Text/HTML; charset=utf-8")
    return accepted_pages(answered.withColumn("content_type", kind)).select("page_id", "url")


def _archived(spark, sf_dir):
    path = workspace(spark)
    archive.register(spark)
    archive.write_archives(_pages(spark, sf_dir).withColumn("fetched_at", F.timestamp_seconds(F.lit(NOW))), path)
    return path


def _page_digest(pages):
    return pages.select(
        "url", "status", "content_type", F.sha2("html", 256).alias("html_sha256"), F.unix_seconds("fetched_at").alias("fetched")
    )


def page_archive(spark, sf_dir):
    """Pages written as web archives and read back by the data source."""
    return _page_digest(spark.read.format("page_archive").load(_archived(spark, sf_dir)))


def page_archive_stream(spark, sf_dir):
    path = workspace(spark)
    found = _page_digest(spark.readStream.format("page_archive").load(_archived(spark, sf_dir)))
    runs.start_files(found, path, f"{path}-checkpoint", once=True).awaitTermination()
    return spark.read.schema(found.schema).parquet(path)


def page_text(spark, sf_dir):
    return extract(_pages(spark, sf_dir)).select("page_id", "text")


def page_text_native(spark, sf_dir):
    return extract(_pages(spark, sf_dir), native=True).select("page_id", "text")


def page_sentences(spark, sf_dir):
    return explode_sentences(extract(_pages(spark, sf_dir)).select("page_id", "text"))


def gather_pages(spark, sf_dir):
    found = gather.gather(
        _pages(spark, sf_dir), ["page_id"], TARGET, _model(spark, sf_dir),
        timestamp=F.timestamp_seconds(F.lit(NOW)), script=T.LATIN,
    )
    return found.select("hash", "text", "url", F.unix_seconds("timestamp").alias("timestamp"))


def extract_links(spark, sf_dir):
    return _page_links(spark, sf_dir)


def extract_links_native(spark, sf_dir):
    found = explode_links(extract(_pages(spark, sf_dir), KEEP_NAV, native=True))
    return found.select("page_id", "pos", "link")


# --- URLs -----------------------------------------------------------------


def canonical_url(spark, sf_dir):
    return _page_urls(spark, sf_dir)


def url_domain(spark, sf_dir):
    return _page_urls(spark, sf_dir).select("page_id", U.url_domain(F.col("url")).alias("domain"))


def distinct_urls(spark, sf_dir):
    return _page_links(spark, sf_dir).select(F.col("link").alias("url")).distinct()


def seed_domains(spark, sf_dir):
    return admission.distinct_domains(_page_urls(spark, sf_dir))


def _french_domains(spark, sf_dir):
    urls = _page_urls(spark, sf_dir)
    return admission.distinct_domains(urls.where(F.col("url").contains("/fr/")))


def allow_all(spark, sf_dir):
    return admission.allow_all(_page_urls(spark, sf_dir))


def allow_exact(spark, sf_dir):
    return admission.allow_exact(_page_urls(spark, sf_dir), _french_domains(spark, sf_dir))


def allow_mixed_case(spark, sf_dir):
    names = _french_domains(spark, sf_dir).select(F.concat(F.lit(" "), F.upper("domain")).alias("domain"))
    return admission.allow_exact(_page_urls(spark, sf_dir), names)


def allow_subdomain(spark, sf_dir):
    bare = F.regexp_replace("domain", r"^(m|www|blog)\.", "").alias("domain")
    return admission.allow_subdomains(
        _page_urls(spark, sf_dir), _french_domains(spark, sf_dir).select(bare)
    )


def same_or_subdomain(spark, sf_dir):
    domain = U.url_domain(F.col("url"))
    return _page_urls(spark, sf_dir).select(
        "page_id",
        U.is_same_or_subdomain(domain, F.lit("example.com")).alias("in_com"),
        U.is_same_or_subdomain(domain, domain).alias("itself"),
    )


def robots_filter(spark, sf_dir):
    urls = _page_urls(spark, sf_dir)
    return robots.robots_allowed(urls, _robots_table(urls), "millrace/1.0")


# --- visits and limits ----------------------------------------------------


def _visited(spark, sf_dir):
    seen = _events(spark, sf_dir).select(F.col("user_id").cast("string").alias("url"), "sec", "event_id")
    empty = seen.select("url", F.col("sec").alias("last_visited")).where("false")
    return visits.upsert_visits(empty, seen.withColumnRenamed("sec", "last_visited"), "event_id")


def visited_upsert(spark, sf_dir):
    return _visited(spark, sf_dir)


def revisit_due(spark, sf_dir):
    candidates = _events(spark, sf_dir).select("event_id", F.col("user_id").cast("string").alias("url"))
    return admission.revisit_due(candidates, _visited(spark, sf_dir), NOW, 2 * DAY)


def revisit_gate(spark, sf_dir):
    admitted = visits.revisit_gate(_events(spark, sf_dir), "user_id", "sec", ["event_id"], DAY)
    return admitted.select("event_id", "user_id", "sec")


def not_queued(spark, sf_dir):
    links = _page_links(spark, sf_dir).select(F.col("link").alias("url")).distinct()
    queue = links.where(F.col("url").rlike("/[a-m][^/]*$"))
    return admission.not_queued(links, queue)


def page_cap(spark, sf_dir):
    queue = seed_frontier(
        _pages(spark, sf_dir).select(F.col("url").alias("seed"), F.col("page_id").alias("ord"))
    )
    return first_rows(queue, frontier.MAX_PAGES, F.col("depth"), F.col("ord"))


def queue_cap(spark, sf_dir):
    return first_rows(store(_page_links(spark, sf_dir)), frontier.MAX_QUEUE, F.col("page_id"), F.col("pos"))


def _crawl_pages(spark, sf_dir):
    """Pages keyed by canonical URL, and those URLs as a queue."""
    # Copies of a canonical URL are reduced on the narrow columns, before HTML is read.
    urls = store(_page_urls(spark, sf_dir).groupBy("url").agg(F.min("page_id").alias("page_id")))
    html = _pages(spark, sf_dir).select("page_id", "html")
    pages = html.join(urls, "page_id").withColumn("fetched_at", F.timestamp_seconds(F.lit(NOW)))
    return pages, urls.select("url", F.lit(0).alias("depth"), F.col("page_id").alias("ord"))


def _no_visits(spark):
    return spark.createDataFrame([], "url string, last_visited bigint")


def _cycle(spark, sf_dir):
    pages, queue = _crawl_pages(spark, sf_dir)
    options = frontier.CycleOptions(
        target=None, script=T.LATIN, max_depth=1, max_pages=None, max_queue=None, drop_tags=KEEP_NAV
    )
    return frontier.run_cycle(pages, queue, _no_visits(spark), admission.distinct_domains(queue), NOW, options)


def frontier_visits(spark, sf_dir):
    return _cycle(spark, sf_dir).visits


def frontier_sentences(spark, sf_dir):
    return _cycle(spark, sf_dir).sentences.select("text", "url", "hash")


def depth_cap(spark, sf_dir):
    """Levels of a crawl from the first page of each domain: links of linked pages are too deep."""
    pages, queue = _crawl_pages(spark, sf_dir)
    domain = U.url_domain(F.col("url"))
    first = queue.groupBy(domain.alias("domain")).agg(F.min("ord").alias("ord"))
    seeds = store(queue.join(first, "ord", "left_semi"))
    options = frontier.CycleOptions(
        target=None, script=T.LATIN, max_depth=1, max_pages=None, max_queue=None, drop_tags=KEEP_NAV
    )
    domains = admission.distinct_domains(queue)
    return frontier.run_cycle(pages, seeds, _no_visits(spark), domains, NOW, options).admitted


def _robots_table(urls):
    body = F.lit("User-agent: other\nDisallow: /\n\nUser-agent: *\nAllow: /de/1\nDisallow: /de/\n")
    base = U.url_base(F.col("url")).alias("base")
    status = F.when(F.col("base").contains("//blog."), 403).otherwise(200).alias("status")
    return urls.select(base).distinct().select("base", status, body.alias("body"))


def _ruled_cycle(spark, sf_dir):
    """A cycle with all its rules at once: allowlist, revisit age, robots, page cap and queue cap."""
    pages, queue = _crawl_pages(spark, sf_dir)
    # Spanish pages were visited a moment ago, German ones long ago.
    age = F.when(F.col("url").contains("/es/"), 100).when(F.col("url").contains("/de/"), 3 * DAY)
    visited = store(queue.select("url", (F.lit(NOW) - age).cast("bigint").alias("last_visited")).where("last_visited IS NOT NULL"))
    bare = F.regexp_replace("domain", r"^(m|www|blog)\.", "").alias("domain")
    options = frontier.CycleOptions(
        target=None, script=T.LATIN, max_depth=1, max_pages=PAGE_CAP, max_queue=queue.count(), drop_tags=KEEP_NAV
    )
    return frontier.run_cycle(
        pages, queue, visited, admission.distinct_domains(queue), NOW, options,
        robots=_robots_table(queue), allowed_domains=_french_domains(spark, sf_dir).select(bare),
    )


def frontier_queue(spark, sf_dir):
    return _ruled_cycle(spark, sf_dir).frontier


def frontier_ruled_visits(spark, sf_dir):
    return _ruled_cycle(spark, sf_dir).visits


def cycle_report(spark, sf_dir):
    began = time.time()
    found = _ruled_cycle(spark, sf_dir).write(workspace(spark), began).as_dict()
    rows = spark.createDataFrame([tuple(found.values())], "pages bigint, sentences_written bigint, queue bigint, elapsed double")
    return rows.select("pages", "sentences_written", "queue", (F.col("elapsed") > 0).alias("timed"))


# --- files ----------------------------------------------------------------


def text_column(spark, sf_dir):
    return files.text_column(_table(spark, sf_dir, "conversations"), "text")


def read_parquet(spark, sf_dir):
    rows = files.read_text_files(spark, f"{sf_dir}/documents.parquet", "parquet")
    return files.text_column(rows, "text", keep=("doc_id",))


def read_jsonl(spark, sf_dir):
    path = workspace(spark)
    _documents(spark, sf_dir).select("doc_id", "text", "lang").write.json(path)
    return files.read_text_files(spark, path, "jsonl")


def read_text_column(spark, sf_dir):
    """JSON lines of which most do not have the column (a null text); it holds numbers, and is a string all the same."""
    path = workspace(spark)
    number = F.when(F.col("doc_id") % 10 == 9, F.col("n_chars"))
    _documents(spark, sf_dir).select("doc_id", number.alias("size")).write.json(path)
    return files.read_text_column(spark, path, "jsonl", "size")


def list_files(spark, sf_dir):
    """Which languages have a file, from documents written in a folder for each."""
    path = workspace(spark)
    # Each task writes a file for each of its languages: no task gets all texts of one.
    _documents(spark, sf_dir).select("lang", "text").write.partitionBy("lang").json(path)
    found = files.list_text_files(spark, path, "jsonl")
    names = spark.createDataFrame([(f,) for f in found], "file string")
    return names.select(F.regexp_extract("file", "lang=([^/]*)/", 1).alias("lang")).distinct()


def read_seeds(spark, sf_dir):
    path = workspace(spark)
    lines = F.explode(F.array(F.lit("# a page"), F.lit(""), F.concat(F.lit(" "), "url")))
    _pages(spark, sf_dir).select(lines.alias("value")).write.text(path)
    return seed_frontier(pages_source.read_seeds(spark, path)).select("url", "depth")


def crawl_state(spark, sf_dir):
    """Visits by user, one cycle for each half of the events: what the state says after both."""
    state = output.CrawlState(spark, f"{workspace(spark)}-state")
    events = _events(spark, sf_dir)
    middle = events.agg(F.expr("(min(sec) + max(sec)) div 2").alias("m")).head().m
    for cycle, part in enumerate((events.where(F.col("sec") <= middle), events.where(F.col("sec") > middle))):
        last = part.groupBy(F.col("user_id").cast("string").alias("url")).agg(F.max("sec").alias("last_visited"))
        state.commit(cycle, visited=last)
    return state.visited()


def visit_buckets(spark, sf_dir):
    """The same in a table of buckets, of which an upsert rewrites those it touches."""
    table = visits.VisitTable(spark, f"{workspace(spark)}-visits", 16)
    events = _events(spark, sf_dir)
    middle = events.agg(F.expr("(min(sec) + max(sec)) div 2").alias("m")).head().m
    for part in (events.where(F.col("sec") > middle), events.where(F.col("sec") <= middle)):
        table.upsert(part.select(F.col("user_id").cast("string").alias("url"), F.col("sec").alias("last_visited")))
    return table.read()


def reseed(spark, sf_dir):
    """An empty queue gets the seeds again, each once."""
    seeds = _page_urls(spark, sf_dir).where("url <> ''").select("url", F.lit(0).alias("depth"), F.col("page_id").alias("ord"))
    return frontier.reseed(seeds.where("false"), seeds)


def read_csv(spark, sf_dir):
    path = workspace(spark)
    rows = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    rows.write.options(
        header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
    return files.read_text_files(spark, path, "csv")


def read_txt(spark, sf_dir):
    path = workspace(spark)
    _documents(spark, sf_dir).select("text").write.text(path)
    return files.read_text_files(spark, path, "txt")


def read_dataset(spark, sf_dir):
    root = workspace(spark)
    _table(spark, sf_dir, "conversations").write.parquet(f"{root}/chat/plain")
    found = files.read_dataset(spark, root, "chat", "plain", split="part")
    return files.text_column(found, "text", keep=("conv_id", "turn"))


def write_sentences(spark, sf_dir):
    path = workspace(spark)
    rows = _doc_sentences(spark, sf_dir).select(
        F.col("sentence").alias("text"),
        F.concat(F.lit("doc:"), "doc_id").alias("url"),
        F.timestamp_seconds(F.lit(NOW)).alias("timestamp"),
    )
    output.write_sentences(rows, path)
    return spark.read.schema("text string, url string, timestamp string").json(path)


# --- tokens ---------------------------------------------------------------


def _digest(tokens: DataFrame, *keys: str) -> DataFrame:
    """Token lists as a length and a hash, which keeps results small and comparable."""
    joined = F.array_join(F.col("input_ids").cast("array<string>"), " ")
    return tokens.select(
        *keys, F.size("input_ids").cast("bigint").alias("n"), F.md5(joined).alias("ids_md5")
    )


def tokenize_bytes(spark, sf_dir):
    docs = files.text_column(_documents(spark, sf_dir), "text", keep=("doc_id",))
    return _digest(corpus.tokenize(docs), "doc_id")


def tokenize_bytes_native(spark, sf_dir):
    docs = files.text_column(_documents(spark, sf_dir), "text", keep=("doc_id",))
    return _digest(corpus.tokenize(docs, K.byte_tokens_native), "doc_id")


def truncate_tokens(spark, sf_dir):
    docs = files.text_column(_documents(spark, sf_dir), "text", keep=("doc_id",))
    short = corpus.truncated(docs, SEQ_LEN)
    ones = F.aggregate("attention_mask", F.lit(0), lambda a, m: a + m).cast("bigint")
    return _digest(short.withColumn("ones", ones), "doc_id", "ones")


def exact_length(spark, sf_dir):
    docs = files.text_column(_documents(spark, sf_dir), "text", keep=("doc_id",))
    short = corpus.truncated(docs, SEQ_LEN)
    return short.where(K.full_length(F.col("input_ids"), SEQ_LEN)).select("doc_id")


def pack_blocks(spark, sf_dir):
    docs = index_by_key(_documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    blocks = corpus.tokenize_dataset(docs, SEQ_LEN, True, batch_rows=BATCH_ROWS)
    return _digest(blocks, "batch_id", "block_id")


def pack_shards(spark, sf_dir):
    docs = index_by_file(spark, f"{sf_dir}/documents.parquet", "text")
    blocks = corpus.tokenize_dataset(docs, SEQ_LEN, True, batch_rows=BATCH_ROWS, shards=3)
    return _digest(blocks, "shard", "batch_id", "block_id")


def build_corpus(spark, sf_dir):
    blocks = corpus.build_corpus(
        spark, f"{sf_dir}/documents.parquet", "parquet", seq_len=SEQ_LEN, batch_rows=BATCH_ROWS
    )
    return _digest(blocks, "batch_id", "block_id")


def _dataset(spark, sf_dir):
    """The documents as split ``train`` of a named dataset, its files in the order of their ids."""
    root = workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.parquet(f"{root}/docs/train")
    return root


def corpus_dataset(spark, sf_dir):
    root = _dataset(spark, sf_dir)
    blocks = corpus.build_from_dataset(spark, root, "docs", seq_len=SEQ_LEN, batch_rows=BATCH_ROWS)
    return _digest(blocks, "batch_id", "block_id")


def corpus_stream(spark, sf_dir):
    path = workspace(spark)
    tokens = corpus.build_from_dataset(
        spark, _dataset(spark, sf_dir), "docs", seq_len=SEQ_LEN, pack=False, streaming=True, keep=("doc_id",)
    )
    runs.start_files(tokens, path, f"{path}-checkpoint", once=True).awaitTermination()
    return _digest(spark.read.schema(tokens.schema).parquet(path), "doc_id")


def collate(spark, sf_dir):
    docs = index_by_file(spark, f"{sf_dir}/documents.parquet", "text")
    # Padding with a byte that occurs in texts shows that real tokens equal to it are masked too.
    batches = packing.collate(corpus.truncated(docs, SEQ_LEN), batch_size=16, pad_id=10)
    ignored = F.size(F.filter("labels", lambda i: i == packing.IGNORED_LABEL)).cast("bigint")
    kept = F.aggregate("attention_mask", F.lit(0), lambda a, m: a + m).cast("bigint")
    return _digest(
        batches.withColumn("ignored", ignored).withColumn("kept", kept), "batch_id", "row_idx", "kept", "ignored"
    )


def shuffle_feed(spark, sf_dir):
    docs = index_by_file(spark, f"{sf_dir}/documents.parquet", "doc_id")
    rows = docs.count()
    feed = packing.training_order(docs, "row_idx", SEED, rows + rows // 2, rows)
    return feed.select("epoch", "doc_id", "feed_key")


# --- streams --------------------------------------------------------------


def _stream(spark, sf_dir, name):
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    # A file source streams a folder: the table's own, or that of a table which is one file.
    if files.is_file(spark, path):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def stream_distinct(spark, sf_dir):
    path = workspace(spark)
    found = explode_sentences(_stream(spark, sf_dir, "documents").select("doc_id", "text"))
    query = runs.start_files(
        runs.distinct_stream(found.select("sentence"), "sentence"), path, f"{path}-checkpoint", once=True
    )
    query.awaitTermination()
    return spark.read.schema("hash string, sentence string").parquet(path)


def stream_gather(spark, sf_dir):
    path = workspace(spark)
    state = output.CrawlState(spark, f"{path}-state")
    query = runs.start_gather(
        _stream(spark, sf_dir, "pages"), ["page_id"], path, state, f"{path}-checkpoint", None,
        once=True, script=T.LATIN, timestamp=F.timestamp_seconds(F.lit(NOW)),
    )
    query.awaitTermination()
    return spark.read.schema("text string, url string, timestamp string, cycle bigint").json(path).drop("cycle")


def state_resume(spark, sf_dir):
    """Two streams, each with a checkpoint of its own, share one state: every sentence once."""
    path = workspace(spark)
    state = output.CrawlState(spark, f"{path}-state")
    for number in range(2):
        runs.start_gather(
            _stream(spark, sf_dir, "pages").where(F.col("page_id") % 2 == number), ["page_id"], path, state,
            f"{path}-checkpoint-{number}", None, once=True, script=T.LATIN, timestamp=F.timestamp_seconds(F.lit(NOW)),
        ).awaitTermination()
    return spark.read.schema("text string, cycle bigint").json(path).select("text")


def stream_tokens(spark, sf_dir):
    path = workspace(spark)
    docs = files.text_column(_stream(spark, sf_dir, "documents"), "text", keep=("doc_id",))
    tokens = corpus.tokenize_dataset(docs, SEQ_LEN, pack=False)
    runs.start_files(tokens, path, f"{path}-checkpoint", once=True).awaitTermination()
    return _digest(spark.read.schema(tokens.schema).parquet(path), "doc_id")


def _event_stream(spark, sf_dir):
    return _stream(spark, sf_dir, "events").selectExpr("event_id", "user_id", SECONDS)


def stream_gate(spark, sf_dir):
    path = workspace(spark)
    admitted = gate.revisit_gate_stream(_event_stream(spark, sf_dir), "user_id", "sec", "event_id", DAY)
    runs.start_files(admitted, path, f"{path}-checkpoint", once=True).awaitTermination()
    return spark.read.schema(admitted.schema).parquet(path)


def stream_gate_table(spark, sf_dir):
    path = workspace(spark)
    state = output.CrawlState(spark, f"{path}-state")
    events = _event_stream(spark, sf_dir)
    query = runs.start_revisit_gate(
        events, "user_id", "sec", ["event_id"], DAY, path, state, f"{path}-checkpoint", once=True
    )
    query.awaitTermination()
    return spark.read.schema(events.schema).parquet(path).drop("cycle")


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    norm_text, split_sentences, min_length, sentence_hash, script_ratio, script_filter,
    dedup_first, anti_seen,
    langid_fit, langid_profile, langid_predict, langid_predict_join, target_filter,
    page_source, page_archive, page_archive_stream, page_text, page_text_native, page_sentences, gather_pages,
    extract_links, extract_links_native,
    canonical_url, url_domain, distinct_urls, seed_domains,
    allow_all, allow_exact, allow_mixed_case, allow_subdomain, same_or_subdomain, robots_filter,
    visited_upsert, revisit_due, revisit_gate, not_queued, depth_cap, page_cap, queue_cap,
    cycle_report, frontier_visits, frontier_sentences, frontier_queue, frontier_ruled_visits,
    text_column, read_text_column, list_files, read_seeds, crawl_state, visit_buckets, reseed, read_parquet, read_jsonl, read_csv, read_txt, read_dataset, write_sentences,
    tokenize_bytes, tokenize_bytes_native, truncate_tokens, exact_length,
    pack_blocks, pack_shards, build_corpus, corpus_dataset, corpus_stream, collate, shuffle_feed,
    stream_distinct, stream_gather, state_resume, stream_tokens, stream_gate, stream_gate_table,
)
