"""Benchmark decontamination by a prefix-filtered set join (operator 7); DataFrame expressions only.

Every item is cut into windows of ``size`` consecutive words (a shorter item is one window). To contain a whole window
a document must hold all its words, so the necessary prefix of a window, its words ordered by rarity over
all documents, is the rarest one. Documents are exploded into (position, word) and joined with the windows on that word
only. The word's place in the window gives the one start that the occurrence allows, the length bound drops starts
that leave no room, and the remaining words are compared exactly, all within the stage that reads the documents.

Windows are broadcast in blocks of at most ``BLOCK_BYTES`` by measure; more windows take more rounds over the
documents. The vocabulary is broadcast only if it is measured to be as small.

Words are joined under Unicode's lower case, which maps at least A-Z; the exact comparison lower-cases A-Z alone.

Defined cases: null texts and texts without words have no words, no windows and no hits. Rows are judged one by one,
also those that share a doc_id; equal rows get equal results. A window of several items counts for each of them. Null
item ids are left out of the list of items, as they have no name, but their windows hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import ASCII_LOWER, ASCII_UPPER, beside, table
from cartloom.session import cut_lineage

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
BLOCK_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    """Words in their own case."""
    return F.array_remove(F.split(text, SEPARATORS, -1), "")


def exact(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """(item_id, window): the windows of items (item_id, text), as words lower-cased and joined by spaces."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(exact("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - size + 1))
    return words.select("item_id", "words", F.explode(starts).alias("start")).select(
        "item_id", F.array_join(F.slice("words", F.col("start"), size), " ").alias("window")).distinct()


def _measured(df: DataFrame, column: str) -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(column) + 64), F.lit(0))).first()[0]


def _rarity(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, n): occurrences of the vocabulary's words in all documents; words merge before the shuffle."""
    words = docs.select(F.explode(words_of("text")).alias("word")).select(F.lower("word").alias("word"))
    if _measured(vocabulary, "word") <= BLOCK_BYTES:
        words = words.join(F.broadcast(vocabulary), "word", "left_semi")
        return words.groupBy("word").agg(F.count("*").alias("n"))
    return words.groupBy("word").agg(F.count("*").alias("n")).join(vocabulary, "word", "left_semi")


def _prefixes(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Distinct windows with the rarest word, its first place, the number of words and a key."""
    distinct = windows.select("window").distinct().withColumn("words", F.split("window", " "))
    placed = distinct.select("window", F.size("words").alias("length"), F.posexplode("words").alias("place", "own"))
    placed = placed.withColumn("word", F.lower("own"))
    counts = _rarity(docs, cut_lineage(placed.select("word").distinct()))
    ranked = placed.join(counts, "word")  # a word that no document holds drops out
    rarest = ranked.groupBy("window", "length").agg(
        F.min_by(F.struct("word", "place"), F.struct("n", "word", "place")).alias("first"), F.count("*").alias("found"))
    return rarest.where("found = length").select("window", "length", "first.word", "first.place", F.md5("window").alias("window_id"))


def _hits(docs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(doc_id, digest, spans, windows) of documents that hold a window."""
    blocks = max(1, -(-_measured(prefixes, "window") // BLOCK_BYTES))
    found = None
    for block in range(blocks):
        own = prefixes if blocks == 1 else prefixes.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)
        words = docs.select("doc_id", F.xxhash64("text").alias("digest"), words_of("text").alias("words"))
        places = words.select("doc_id", "digest", "words", F.posexplode("words").alias("position", "own"))
        joined = places.withColumn("word", F.lower("own")).join(F.broadcast(own), "word")
        start = F.col("position") - F.col("place")
        fits = (start >= 0) & (start + F.col("length") <= F.size("words"))
        equal = exact(F.array_join(F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("length")), " ")) == F.col("window")
        matched = joined.where(fits).where(equal).select("doc_id", "digest", start.alias("start"), "length", "window_id")
        found = matched if found is None else found.union(matched)
    return found.groupBy("doc_id", "digest").agg(
        F.collect_set(F.struct("start", "length")).alias("spans"), F.collect_set("window_id").alias("windows"))


def _covered(spans: Column) -> Column:
    """Number of words inside any span."""
    begin = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(0).alias("end"))

    def walk(s: Column, p: Column) -> Column:
        end = F.greatest(s["end"], p["start"] + p["length"])
        return F.struct((s["covered"] + end - F.greatest(s["end"], p["start"])).cast("long").alias("covered"), end.alias("end"))

    return F.aggregate(F.array_sort(spans), begin, walk, lambda s: s["covered"])


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, digest of the text, n_words, n_hit, items (sorted ids)."""
    docs = docs.select("doc_id", "text")
    windows = cut_lineage(windows_of(items, size))
    hits = cut_lineage(_hits(docs, cut_lineage(_prefixes(docs, windows))))
    named = windows.where(F.col("item_id").isNotNull()).select(F.md5("window").alias("window_id"), "item_id")
    listed = hits.select("doc_id", "digest", F.explode("windows").alias("window_id")).join(named, "window_id").groupBy(
        "doc_id", "digest").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    hit = hits.select("doc_id", "digest", _covered(F.col("spans")).alias("n_hit")).alias("h")
    found = hit.join(listed.alias("l"), F.expr("h.doc_id <=> l.doc_id AND h.digest = l.digest"), "left").selectExpr(
        "h.doc_id AS hit_id", "h.digest AS hit_digest", "h.n_hit", "l.items")
    counted = docs.select("doc_id", F.xxhash64("text").alias("digest"), F.coalesce(F.size(words_of("text")), F.lit(0)).cast("long").alias("n_words"))
    counted = counted.withColumn("n_words", F.greatest("n_words", F.lit(0).cast("long")))
    return counted.join(found, F.expr("doc_id <=> hit_id AND digest = hit_digest"), "left").select(
        "doc_id", "digest", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns kept, that hold no window of an item."""
    windows = cut_lineage(windows_of(items, size))
    hits = cut_lineage(_hits(docs.select("doc_id", "text"), cut_lineage(_prefixes(docs, windows))).select(
        F.col("doc_id").alias("hit_id__"), F.col("digest").alias("hit_digest__")))
    return docs.join(beside(hits), docs["doc_id"].eqNullSafe(hits["hit_id__"]) & (F.xxhash64(docs["text"]) == hits["hit_digest__"]), "left_anti")


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP7_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS m, array_to_string(w[s : s + {WINDOW - 1}], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS s FROM b WHERE len(w) > 0)
), pos AS (
  SELECT k, p, m, array_to_string(w[p : p + m - 1], ' ') AS t
  FROM (SELECT k, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT m FROM win) WHERE len(w) >= m)
), hit AS (SELECT k, p, m, item_id FROM pos JOIN win USING (t, m)),
covered AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + m)) AS q FROM hit) GROUP BY k),
listed AS (SELECT k, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hit GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (k) LEFT JOIN listed USING (k)
"""

QUERIES = {"op7_decontaminate": (op7_decontaminate, OP7_SQL)}
