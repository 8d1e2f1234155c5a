"""Repeated passages: winnowed anchors seed matches that grow to maximal repeats."""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import WORD, drop, hash_words, map_batches, mix, ngram_hashes, release, slices, table, written

WINDOW = 20
SEED = 8
SPAN = WINDOW - SEED + 1
#: Odd multipliers of the two span hashes, and their inverses modulo 2 ** 64.
BASES = tuple((np.uint64(b), np.uint64(pow(b, -1, 1 << 64))) for b in (0x9E3779B97F4A7C17, 0xD6E8FEB86659FD93))


def span_hashes(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int = 0) -> np.ndarray:
    """Hashes of the word runs [lo, hi), by differences of polynomial prefix sums."""
    b, inverse = BASES[base]
    with np.errstate(over="ignore"):
        up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(h), b))])
        down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(h), inverse))])
        total = np.concatenate([[np.uint64(0)], np.cumsum(h * up[:-1])])
        return mix((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def anchors(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Seed hash, place, first window and count of windows for each anchor that winnowing picks.

    A window's anchor depends on its words alone, so equal windows have equal
    anchors at equal offsets; the windows of one anchor follow one another.
    """
    g = ngram_hashes(h, SEED)
    if len(g) < SPAN:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    at = np.lib.stride_tricks.sliding_window_view(g, SPAN).argmin(axis=1) + np.arange(len(g) - SPAN + 1)
    lo = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return g[at[lo]], at[lo], lo, np.diff(np.append(lo, len(at)))


def chunks_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows (a, c, first window, windows): anchors with the hash of all words of their windows, once for each content, and the text's own repeats.

    Own repeats are windows whose words also start earlier in the same text;
    their runs have a negative count, and no hashes.
    """
    a, at, lo, n = anchors(h)
    if not len(a):
        return a, a, lo, n
    with np.errstate(over="ignore"):
        c = mix(span_hashes(h, lo, lo + n + WINDOW - 1) + (at - lo).astype(np.uint64))
        first = np.unique(mix(a * np.uint64(3) + c), return_index=True)[1]
    again, size = runs_of(own_repeats(h, a, lo, n))
    none = np.zeros(len(again), dtype=np.uint64)
    return np.concatenate([a[first], none]), np.concatenate([c[first], none]), np.concatenate([lo[first], again]), np.concatenate([n[first], -size])


def window_hashes(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return span_hashes(h, at, at + WINDOW), span_hashes(h, at, at + WINDOW, 1)


def own_repeats(h: np.ndarray, a: np.ndarray, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Windows whose words also start earlier in the same text, given its anchors."""
    _, inverse, often = np.unique(a, return_inverse=True, return_counts=True)
    twice = often[inverse] > 1
    if not twice.any():
        return np.zeros(0, dtype=np.int64)
    at = spread(lo[twice], n[twice])
    x, y = window_hashes(h, at)
    _, first = np.unique(np.stack([x, y]), axis=1, return_index=True)
    return np.delete(at, first)


def runs_of(at: np.ndarray, most: int = 30_000) -> tuple[np.ndarray, np.ndarray]:
    """Runs (first, count) of rising window starts, none longer than `most`."""
    if not len(at):
        return at, at
    first = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]))
    lo, n = at[first], np.diff(np.append(first, len(at)))
    parts = -(-n // most)
    k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)  # the place of a part in its run
    return np.repeat(lo, parts) + k * most, np.minimum(np.repeat(n, parts) - k * most, most)


def spread(lo, n) -> np.ndarray:
    """All window starts of runs (first, count)."""
    lo, n = np.asarray(lo, dtype=np.int64), np.asarray(n, dtype=np.int64)
    return np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(lo) else lo


def cut(words: list[str], starts) -> tuple[list[str], int]:
    """Words outside the repeated windows that begin at starts, and how many are inside."""
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    s = np.unique(np.asarray(starts, dtype=np.int64))
    np.add.at(edge, s, 1)
    np.add.at(edge, s + WINDOW, -1)
    gone = np.cumsum(edge)[:-1] > 0
    return [w for w, x in zip(words, gone) if not x], int(gone.sum())


def place(docs: DataFrame) -> F.Column:
    """What orders documents: doc_id, or where ids are null or have several texts, a struct with the text's hash; null ids come last."""
    odd = docs.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b")).where("doc_id is null or a <> b")
    if odd.isEmpty():
        return F.col("doc_id")
    return F.struct(F.col("doc_id").isNull().alias("n"), F.coalesce("doc_id", F.lit(0)).alias("d"), F.xxhash64("text").alias("h"))


def spans(rows: DataFrame, f, schema: str) -> DataFrame:
    """What f gives for each row, a dict of its columns: arrays of one length, in columns of schema after the row's place p."""
    kinds = [t.split()[1] for t in schema.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "short": pa.int16()}

    def run(batches):
        release()
        names = ["p", *(t.split()[0] for t in schema.split(", "))]
        for b in slices(batches):
            got = [f(dict(zip(b.schema.names, r))) for r in zip(*(c.to_pylist() for c in b.columns))]
            size = [len(g[0]) for g in got]
            cols = [np.concatenate(c) for c in zip(*got)]
            p = b["p"].take(pa.array(np.repeat(np.arange(len(size)), size)))
            yield pa.RecordBatch.from_arrays([p, *(pa.array(c, types[k]) for c, k in zip(cols, kinds))], names=names)

    out = rows.select("p").schema
    for t in StructType.fromDDL(schema).fields:
        out = out.add(t)
    return map_batches(rows, run, out)


def repeats(docs: DataFrame, p) -> DataFrame:
    """(p, runs): runs (first, count) of windows whose words also start earlier, in the same document or another; p is the place of documents.

    Documents meet on winnowed anchors. Around each shared anchor the match is
    extended both ways over the whole stretch of windows that hold it, at once,
    by the hash of the stretch: later documents with an equal stretch are done.
    Where the stretches of one anchor differ, it is extended window by window, but only
    for the first document of each distinct stretch, as all others equal one
    of these. So pairs of occurrences are never listed, and copies add no window
    rows. Runs that meet or overlap make up the maximal repeats.
    """
    held: list = []
    rows = docs.select(p.alias("p"), "text")

    def chunks(r):
        a, c, lo, n = chunks_of(hash_words(WORD.findall(r["text"] or "")))
        return a.astype(np.int64), c.astype(np.int64), lo, n

    every = written(spans(rows, chunks, "a long, c long, lo int, n short"), "chunks", held)
    own, chunk = every.where("n < 0").select("p", "lo", (-F.col("n")).cast("short").alias("n")), every.where("n > 0")
    often = written(chunk.groupBy("a").agg(F.count("*").alias("k")).where("k > 1").select("a"), "anchors", held)
    shared = written(chunk.join(often, "a", "left_semi"), "shared", held)
    groups = written(shared.groupBy("a", "c").agg(F.min("p").alias("first"), F.count("*").alias("k")), "groups", held)
    mixed = groups.groupBy("a").agg(F.count("*").alias("k")).where("k > 1").select("a")
    equal = shared.join(groups.where("k > 1").select("a", "c", "first"), ["a", "c"]).where("p > first").select("p", "lo", "n")
    lead = groups.join(written(mixed, "mixed", held), "a", "left_semi").select(F.col("first").alias("p"), "a", "c")
    runs = shared.join(lead, ["a", "c", "p"], "left_semi").groupBy("p").agg(F.collect_list(F.struct("lo", "n")).alias("runs"))

    def windows(r):
        h = hash_words(WORD.findall(r["text"] or ""))
        at = np.unique(spread([x["lo"] for x in r["runs"]], [x["n"] for x in r["runs"]]))
        x, y = window_hashes(h, at)
        _, first = np.unique(np.stack([x, y]), axis=1, return_index=True)
        return x[first].astype(np.int64), y[first].astype(np.int64), at[first]

    grown = written(spans(rows.join(runs, "p"), windows, "x long, y long, lo int"), "windows", held)
    first = written(grown.groupBy("x", "y").agg(F.min("p").alias("first"), F.max("p").alias("last")).where("first < last").drop("last"), "first", held)
    later = grown.join(first, ["x", "y"]).where("p > first").select("p", "lo", F.lit(1).cast("short").alias("n"))
    out = written(equal.union(later).union(own).groupBy("p").agg(F.collect_list(F.struct("lo", "n")).alias("runs")), "repeats")
    drop(docs.sparkSession, held)
    return out


def cleaned(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns of docs (all, or `keep`) with text less its repeated words (joined by one space where any went), and `__words` and `__removed`, their counts.

    Null or empty text has no words and stays as it is; long texts are read
    whole. Documents are ordered by doc_id; those that share an id by the hash of their
    text, and null ids come last, so every text is compared with all others.
    Rows of equal id and text are one document and are cut alike. An empty table
    gives no rows.
    """
    p = place(docs)
    cols = keep or docs.columns
    found = repeats(docs, p)
    marked = docs.select(*cols, p.alias("__p")).join(found.select(F.col("p").alias("__p"), F.col("runs").alias("__runs")), "__p", "left").select(*cols, "__runs")
    out = docs.select(*cols).schema.add("__words", "long").add("__removed", "long")

    def run(batches):
        release()
        for b in slices(batches):
            texts, n, gone = [], [], []
            for text, runs in zip(b["text"].to_pylist(), b["__runs"].to_pylist()):
                words = WORD.findall(text or "")
                left, k = cut(words, spread([r["lo"] for r in runs], [r["n"] for r in runs])) if runs else (words, 0)
                texts.append(" ".join(left) if k else text)
                n.append(len(words))
                gone.append(k)
            new = {"text": pa.array(texts, pa.string()), "__words": pa.array(n, pa.int64()), "__removed": pa.array(gone, pa.int64())}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else b[c] for c in out.names], names=out.names)

    return map_batches(marked, run, out)


def op10_substrings(spark, sf_dir) -> DataFrame:
    out = cleaned(table(spark, sf_dir, "documents"), ["doc_id", "text"])

    def digest(batches):
        for b in slices(batches):
            kept = [hashlib.sha256(" ".join(WORD.findall(t or "")).encode()).hexdigest() for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["__words"], b["__removed"], pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return map_batches(out, digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
