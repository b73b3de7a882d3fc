"""Benchmark decontamination by winnowing, in DataFrame operations only.

A text becomes the hashes of its words. From every ``window_words - gram + 1``
successive k-gram hashes the smallest is kept as a fingerprint, so two texts
that share ``window_words`` words in a row keep the same fingerprint inside
that span. Documents and items are joined on fingerprints; each hit is then
extended on both sides, as far as a window that holds it can reach, by
comparing word hashes that travel with the fingerprint. Items of fewer words
than a window are one fingerprint of their own, looked up at every position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import in_ascii_lower, let
from millrace.operators.sizing import broadcast_if_small

WINDOW_WORDS = 10
GRAM = 5
#: What stands between words; A-Z are not lower-cased yet.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAP), "")


def _hashes(text: Column) -> Column:
    """A hash for each word, A-Z lower-cased. ``lower`` is much the faster way for ASCII words."""
    plain = lambda w: F.octet_length(w) == F.length(w)
    return F.transform(words(text), lambda w: F.xxhash64(F.when(plain(w), F.lower(w)).otherwise(in_ascii_lower(w))))


def _fingerprints(text: Column, pad: int, window: int, gram: int, short: list[int]) -> Column:
    """Structs (at, gram, span, around): position from 0, hash, 0 or the length of a
    short window, and the word hashes that a window with this k-gram can reach.

    Elements are fetched one by one, as ``slice`` copies the whole array each time.
    Positions past either end are null, which hashing and extremes pass over, so
    windows cut off by an end only add fingerprints.
    """
    reach = window - gram

    def near(values: Column, i: Column, first: int, last: int) -> list[Column]:
        return [F.get(values, i + d) for d in range(first, last + 1)]

    def heads(hashes: Column, n: int) -> Column:
        """Positions at which ``n`` words begin."""
        return F.slice(F.sequence(F.lit(0), F.size(hashes)), 1, F.greatest(F.size(hashes) - n + 1, F.lit(0)))

    def whole(hashes: Column, n: int) -> Column:
        return F.transform(
            heads(hashes, n),
            lambda i: F.struct(
                i.alias("at"),
                _whole(F.array(*near(hashes, i, 0, n - 1)), F.lit(n)).alias("gram"),
                F.lit(n).alias("span"),
                F.array().cast("array<bigint>").alias("around"),
            ),
        )

    def picked(hashes: Column) -> Column:
        def of_grams(grams: Column) -> Column:
            lowest = F.transform(grams, lambda g, j: F.least(*near(grams, j, 0, reach)))
            return let(
                lowest,
                # Every window over i has a minimum of at most its hash.
                lambda low: F.transform(
                    F.filter(heads(hashes, gram), lambda i: F.greatest(*near(low, i, -reach, 0)) == F.get(grams, i)),
                    lambda i: F.struct(
                        i.alias("at"),
                        F.get(grams, i).alias("gram"),
                        F.lit(0).alias("span"),
                        F.array(*(F.coalesce(h, F.lit(pad)) for h in near(hashes, i, -reach, gram - 1 + reach))).alias("around"),
                    ),
                ),
            )

        grams = F.transform(heads(hashes, gram), lambda i: F.xxhash64(*near(hashes, i, 0, gram - 1)))
        found = [let(grams, of_grams)]
        return F.concat(*found, *(whole(hashes, n) for n in short))

    return let(_hashes(text), picked)


def _whole(hashes: Column, n: Column) -> Column:
    return F.xxhash64(n, hashes)


def _hits(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str, item_text: str, window: int, gram: int) -> DataFrame:
    """Spans (doc, item, first, last) of document words inside windows of an item."""
    sized = items.select(
        F.col(item_id).alias("item"), F.col(item_text).alias("_text"), F.size(words(F.col(item_text))).alias("_n")
    )
    # At most ``window`` - 1 numbers.
    short = sorted(r._n for r in sized.where((F.col("_n") > 0) & (F.col("_n") < window)).select("_n").distinct().collect())
    long_items = sized.select(
        "item", F.explode_outer(_fingerprints(F.col("_text"), 1, window, gram, [])).alias("f")
    ).select("item", F.col("f.gram").alias("gram"), F.col("f.around").alias("item_around"))
    short_items = sized.where(F.col("_n").isin(short) if short else F.lit(False)).select(
        "item",
        _whole(_hashes(F.col("_text")), F.col("_n")).alias("gram"),
        F.array().cast("array<bigint>").alias("item_around"),
    )
    tested = long_items.unionByName(short_items).where("gram IS NOT NULL").distinct()
    found = (
        docs.select(
            F.col(doc_id).alias("doc"),
            # Not explode: its inferred filter would work out the fingerprints a second time.
            F.explode_outer(_fingerprints(F.col(text), 0, window, gram, short)).alias("f"),
        )
        .select("doc", "f.at", "f.gram", "f.span", "f.around")
        .join(broadcast_if_small(tested), "gram")
    )
    reach = window - gram
    same = F.concat_ws(
        "", F.zip_with("around", "item_around", lambda a, b: F.when(a == b, "1").otherwise("0"))
    )
    found = found.select("doc", "item", "at", "span", same.alias("same"))
    left = F.length(F.regexp_extract(F.substring("same", 1, reach), "1*$", 0))
    right = F.length(F.regexp_extract(F.substring("same", reach + gram + 1, reach), "^1*", 0))
    runs = found.select(
        "doc", "item", "at", "span", left.alias("left"), right.alias("right"),
        (F.substring("same", reach + 1, gram) == "1" * gram).alias("core"),
    )
    whole = F.col("span") > 0
    return runs.where(whole | (F.col("core") & (F.col("left") + F.col("right") + gram >= window))).select(
        "doc",
        "item",
        F.when(whole, F.col("at")).otherwise(F.col("at") - F.col("left")).alias("first"),
        F.when(whole, F.col("at") + F.col("span") - 1)
        .otherwise(F.col("at") + gram - 1 + F.col("right"))
        .alias("last"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    gram: int = GRAM,
) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_words, n_hit, items, contaminated).

    ``n_hit`` counts the words inside any occurrence of a window: ``window``
    words in a row of an item, or the whole of an item with fewer. ``items``
    are the items with such windows, as strings, sorted.

    Null and empty texts have no words and no hits. Rows that share a doc_id (or
    have none) are judged together: what hits one, hits all. Items without an id
    hit words but are not listed. Other columns are ignored. No documents give no
    rows; an empty benchmark gives no hits.
    """
    runs = _hits(docs, benchmark, doc_id, item_id, text, item_text, window, gram)
    per_doc = runs.groupBy("doc").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(F.sequence("first", "last"))))).cast("bigint").alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"),
    )
    counted = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.size(words(F.col(text))).cast("bigint").alias("n_words"),
    )
    joined = counted.join(per_doc, F.col("doc_id").eqNullSafe(F.col("doc")), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that share no window with the benchmark."""
    runs = _hits(docs, benchmark, doc_id, options.pop("item_id", "item_id"), text,
                 options.pop("item_text", "text"), options.pop("window", WINDOW_WORDS), options.pop("gram", GRAM))
    hit = runs.select("doc").distinct()
    return docs.join(hit, docs[doc_id].eqNullSafe(hit["doc"]), "left_anti")
