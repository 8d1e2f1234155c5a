"""Benchmark items inside documents: MinHash sketches by item size find candidates, exact containment decides."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_words, drop, table, written

N = 5
#: Upper bounds of the sizes (distinct shingles) of item partitions; one more holds all larger items.
SIZES = (8, 16, 32, 64, 128, 256, 512, 1024)
KEY = ["h1", "h2"]


def shingles(words, n: int):
    """Distinct hashes of n consecutive words; an array of fewer words has none."""
    parts = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    return F.when(F.size(words) >= n, F.array_distinct(parts)).otherwise(F.array().cast("array<long>"))


def of_items(items: DataFrame, least: int) -> DataFrame:
    """(item_id, n, size, all shingles) of items; those of under N words are one shingle of all their words."""
    w = items.where("item_id is not null").select("item_id", clean_words(F.col("text")).alias("w")).where(F.size("w") >= least)
    n = F.least(F.size("w"), F.lit(N))
    parts = F.coalesce(*[F.when(n == k, shingles(F.col("w"), k)) for k in range(1, N + 1)])
    rows = w.select("item_id", n.alias("n"), F.explode(parts).alias("h")).distinct()
    return rows.groupBy("item_id").agg(F.collect_set("n").alias("n"), F.count_distinct("h").alias("size"), F.collect_set("h").alias("all"))


def sketched(sets: DataFrame, threshold: float) -> DataFrame:
    """(item_id, h): each item's minimum hashes, as many as its size partition asks for.

    A partition's sketch has one hash more than may be missing from its largest
    items, so a document that holds `threshold` of an item holds one of them.
    The last partition has no bound, so there an item's own size counts.
    """
    bound = F.col("size")
    for most in reversed(SIZES):
        bound = F.when(F.col("size") <= most, F.lit(most)).otherwise(bound)
    k = F.floor((1 - threshold) * bound + F.lit(1e-9)).cast("int") + 1
    least = F.slice(F.array_sort(F.transform("all", lambda h: F.struct(F.xxhash64(h).alias("o"), h.alias("h")))), F.lit(1), k)
    return sets.select("item_id", F.explode(least).alias("x")).select("item_id", "x.h")


def found_texts(docs: DataFrame, items: DataFrame, threshold: float, least: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, h1, h2, item_id) of candidates and (h1, h2, item_id, shared, size) of texts that do hold an item; h1 and h2 name a text."""
    spark, held = docs.sparkSession, []
    sets = written(of_items(items, least), "items", held)
    lengths = sorted({n for r in sets.select("n").distinct().collect() for n in r.n})  # at most N numbers

    def held_by(rows, *keys):
        words = rows.select(*keys, clean_words(F.col("text")).alias("w"))
        parts = [shingles(F.col("w"), n) for n in lengths] or [F.array().cast("array<long>")]
        return words.select(*keys, F.explode(F.concat(*parts)).alias("h"))

    rows = docs.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2"), "text")
    hits = held_by(rows, "doc_id", *KEY).join(sketched(sets, threshold), "h")
    candidates = written(hits.select("doc_id", *KEY, "item_id").distinct(), "candidates")
    texts = rows.join(candidates.select(*KEY).distinct(), KEY, "left_semi")
    whole = sets.select("item_id", "size", F.explode("all").alias("h"))
    shared = held_by(texts, *KEY).join(whole, "h").groupBy(*KEY, "item_id").agg(F.count_distinct("h").alias("shared"), F.first("size").alias("size"))
    exact = shared.join(candidates.select(*KEY, "item_id").distinct(), [*KEY, "item_id"], "left_semi").where(F.col("shared") >= threshold * F.col("size"))
    exact = written(exact, "contained")
    drop(spark, held)
    return candidates, exact


def search(docs: DataFrame, items: DataFrame, threshold: float = 0.8, least: int = 3) -> DataFrame:
    """(doc_id, item_id, shared, size, containment) for items at least `threshold` of whose shingles a document holds.

    Shingles have five words. An item of fewer is found as a whole, if it has at
    least `least` words: shorter ones are everyday phrases that would take clean
    documents with them, and match nothing, like null or empty texts. Items are
    partitioned by size; documents that hold a hash of an item's sketch are its
    candidates, and exact counts over all shingles of candidates follow. A
    partition's sketch is so long that no item is missed. Documents are searched
    whole, however long. Repeated rows count once; of several texts of one id
    each is searched, and the fullest match is given. Documents with a null id
    come out with it; items with a null id are left out. Empty tables give no
    rows; other columns are not read.
    """
    candidates, exact = found_texts(docs, items, threshold, least)
    rows = candidates.join(exact, [*KEY, "item_id"]).groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("shared") / F.col("size")).alias("c"), "shared", "size")).alias("m"))
    return rows.select("doc_id", "item_id", "m.shared", F.col("m.size").alias("size"), F.col("m.c").alias("containment"))


def without(docs: DataFrame, items: DataFrame, threshold: float = 0.8, least: int = 3) -> DataFrame:
    """The rows of docs whose text holds no item, as `search` finds them; rows are judged by their text, whatever their id."""
    exact = found_texts(docs, items, threshold, least)[1].select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2")).distinct()
    rows = docs.withColumns({"__h1": F.xxhash64("text"), "__h2": F.xxhash64("text", F.lit(1))})
    return rows.join(exact, ["__h1", "__h2"], "left_anti").select(*docs.columns)


def op7_decontaminate(spark, sf_dir) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
