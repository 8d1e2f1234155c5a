"""Hashed n-gram log-likelihood ratio between trusted text and the raw corpus."""
from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, arrow_schema, as_batch, drop, hash_words, mix, ngram_hashes, per_batch, slices, table, written

BUCKETS = 1 << 16
SYMBOLS = frozenset("#*$%&|<>")
#: Bits of the map that leaves out documents without a label; about a quarter are set at five million labels.
SIEVE = 1 << 25
COUNTED = "doc_id long, counts binary, failed boolean, b long, raw long"


def buckets_of(words: list[str], buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all words and word pairs."""
    h = hash_words(words)
    return (np.concatenate([h, ngram_hashes(h, 2)]) % np.uint64(buckets)).astype(np.int64)


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    triples = list(zip(words, words[1:], words[2:]))
    often = Counter(triples)
    marks = bytearray(len(words))
    for i, t in enumerate(triples):
        if often[t] > 1:
            marks[i:i + 3] = b"\1\1\1"
    return len(words), sum(map(len, words)), sum(text.count(s) for s in SYMBOLS), dup, sum(marks)


def packed_counts(at: np.ndarray, own: np.ndarray) -> bytes:
    """Buckets in rising order and their counts, in few bytes."""
    gaps = np.diff(at, prepend=0)
    kinds = [next(k for k in ("<u1", "<u2", "<u4") if v.max() <= np.iinfo(k).max) for v in (gaps, own)]
    return bytes([int(k[2]) for k in kinds]) + gaps.astype(kinds[0]).tobytes() + own.astype(kinds[1]).tobytes()


def unpacked(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = (len(b) - 2) // (b[0] + b[1])
    gaps = np.frombuffer(b, f"<u{b[0]}", n, 2)
    return np.cumsum(gaps, dtype=np.int64), np.frombuffer(b, f"<u{b[1]}", n, 2 + n * b[0]).astype(np.int64)


def places(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the sieve for each id: their words and masks."""
    h = mix(ids.astype(np.uint64))
    at = np.stack([h, h >> np.uint64(32)]) % np.uint64(SIEVE)
    return (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def sieve_of(marks: DataFrame) -> np.ndarray:
    """A bit map with both bits of every labelled id; other ids may have them too."""
    def fill(frames):
        bits = np.zeros(SIEVE // 64, dtype=np.uint64)
        for f in frames:
            np.bitwise_or.at(bits, *places(f["doc_id"].to_numpy(dtype=np.int64)))
        at = np.flatnonzero(bits)
        yield pd.DataFrame({"b": at, "v": bits[at].view(np.int64)})

    bits = np.zeros(SIEVE // 64, dtype=np.uint64)
    got = marks.select("doc_id").mapInPandas(fill, "b long, v long").groupBy("b").agg(F.bit_or("v").alias("v")).toPandas()
    bits[got["b"].to_numpy(dtype=int)] = got["v"].to_numpy(dtype=np.int64).view(np.uint64)
    return bits


def in_sieve(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at, mask = places(ids)
    return (bits[at] & mask != 0).all(axis=0)


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, spread: float = 6.0) -> tuple[np.ndarray, float]:
    """Log ratios by bucket and the threshold, from counts over all documents.

    Trusted text is all that labels give quality 1. The threshold lies `spread`
    standard deviations under the mean document score of trusted text, but not
    under the middle between this mean and that of text of quality 0. Each
    document is scored without its own counts and with equal weight, so that long
    ones do not set it; documents that base rules fail are left out. Without
    either class every document passes. Labels meet packed counts of documents,
    not texts; a bit map of `SIEVE` bits over labelled ids, of one size for any
    number of labels, only leaves out documents that have no label. Only it, a
    table of `buckets` rows and the means come to the driver, whatever the
    corpus holds.
    """
    held: list = []
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("q")).where("q in (0, 1)")
    sieve = docs.sparkSession.sparkContext.broadcast(sieve_of(marks))

    def count(batches):
        totals, schema = np.zeros(buckets, dtype=np.int64), arrow_schema(COUNTED)
        for b in slices(batches):
            out, ids = [], b["doc_id"].to_pylist()
            there = in_sieve(sieve.value, np.array([i or 0 for i in ids], dtype=np.int64))
            for i, text, m in zip(ids, b["text"].to_pylist(), there):
                at, own = np.unique(buckets_of(WORD.findall(text or ""), buckets), return_counts=True)
                totals[at] += own
                if m and i is not None and len(at):
                    out.append((i, packed_counts(at, own), base_failed(*base_counts(text)), None, None))
            yield as_batch(list(zip(*out)) or [[]] * 5, schema)
        at = np.flatnonzero(totals)
        none = [None] * len(at)
        yield as_batch([none, none, none, at, totals[at]], schema)

    counted = written(docs.select("doc_id", "text").mapInArrow(count, COUNTED), "counted", held)
    labelled = written(counted.where("doc_id is not null").join(marks, "doc_id").select("counts", "failed", "q"), "labelled", held)

    def trusted(frames):
        total = np.zeros(buckets, dtype=np.int64)
        for f in frames:
            for c in f["counts"]:
                at, own = unpacked(c)
                total[at] += own
        at = np.flatnonzero(total)
        yield pd.DataFrame({"b": at, "v": total[at]})

    n = np.zeros((2, buckets))
    for i, rows in enumerate((counted.where("b is not null").select("b", F.col("raw").alias("v")), labelled.where("q = 1").select("counts").mapInPandas(trusted, "b long, v long"))):
        got = rows.groupBy("b").agg(F.sum("v").alias("v")).toPandas()
        n[i, got["b"].to_numpy(dtype=int)] = got["v"]
    p = (n + 0.5) / (n.sum(axis=1, keepdims=True) + 0.5 * buckets)
    ratio = np.log(p[1] / p[0])
    model = docs.sparkSession.sparkContext.broadcast(n)

    def left_out(frames):
        raw, good = model.value
        sums = np.zeros((2, 3))
        for f in frames:
            for c, q in zip(f["counts"], f["q"]):
                at, own = unpacked(c)
                mine = own if q == 1 else 0 * own
                up = np.log((good[at] - mine + 0.5) / (good.sum() - mine.sum() + 0.5 * buckets))
                down = np.log((raw[at] - own + 0.5) / (raw.sum() - own.sum() + 0.5 * buckets))
                v = float(((up - down) * own).sum() / own.sum())
                sums[q] += (1, v, v * v)
        yield pd.DataFrame({"q": [0, 1], "n": sums[:, 0], "s": sums[:, 1], "ss": sums[:, 2]})

    sums = {r["q"]: r for r in labelled.where("not failed").select("counts", "q").mapInPandas(left_out, "q int, n double, s double, ss double").groupBy("q").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")]).where("n > 0").collect()}
    drop(docs.sparkSession, held)
    if len(sums) < 2:
        return ratio, float("-inf")
    low, high = (sums[q]["s"] / sums[q]["n"] for q in (0, 1))
    deviation = max(sums[1]["ss"] / sums[1]["n"] - high * high, 0.0) ** 0.5
    return ratio, float(min(max((low + high) / 2, high - spread * deviation), high))


def base_failed(n: int, chars: int, symbols: int, dup: int, repeated: int, min_words: int = 50) -> bool:
    return n < min_words or 100 * repeated > 50 * n


def score(docs: DataFrame, ratio: np.ndarray, threshold: float, min_words: int = 50) -> DataFrame:
    """Judge every document of (doc_id, text).

    Null or empty text has no words and fails; its score is 0. Texts are read
    whole, however long. Repeated rows and null ids are judged one by one;
    columns beyond doc_id and text are not read; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(ratio)  # `buckets` doubles

    def judge(b):
        r, out = model.value, []
        for text in b["text"].to_pylist():
            counts = base_counts(text)
            at = buckets_of(WORD.findall(text or ""), len(r))
            s = float(r[at].mean()) if len(at) else 0.0
            failed = base_failed(*counts, min_words)
            out.append((*counts, failed, not failed and s >= threshold, s))
        return [b["doc_id"], *zip(*out)]

    return per_batch(docs.select("doc_id", "text"), judge, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, llr double")


def op1_quality(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, *fit(docs, table(spark, sf_dir, "labels")))
