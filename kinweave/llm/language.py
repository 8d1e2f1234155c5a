"""Language ID by unigram piece models that sum over all segmentations."""
from __future__ import annotations

import re
import uuid
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, map_batches, per_batch, slices, table

UNKNOWN = 1e-7
#: Distinct words that a worker remembers with their likelihoods.
CACHE = 200_000
BASE = np.uint64(0x9E3779B97F4A7C15)


#: Letters and, as few texts have, signs such as ² and Ⅷ, which `words_of` cuts out.
NEARLY = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of Unicode letters (category L), lower-cased, in learning as in prediction."""
    words = NEARLY.findall(text.lower()) if text else []
    if all(map(str.isalpha, words)):
        return words
    return "".join(c if c.isalpha() else " " for w in words for c in (*w, " ")).split()


@lru_cache
def vocabulary(path: str) -> frozenset[str]:
    """All pieces of a public vocabulary that are letters, with or without the mark of a word's start."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()))
    return frozenset(p for p in pieces if p == "▁" or p.removeprefix("▁").isalpha())


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text is divisible by 5; a null id is never learned from, so it counts as held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def edges(word: str, vocab, longest: int) -> list[list[tuple[int, str | None]]]:
    """For each end, the pieces that end there; None is an unknown character."""
    return [[(i, word[i:j]) for i in range(max(0, j - longest), j) if word[i:j] in vocab] or [(j - 1, None)] for j in range(1, len(word) + 1)]


def expected(word: str, prob, longest: int) -> dict[str, float]:
    """Expected piece counts over all segmentations (forward and backward sums).

    Sums that grow small are scaled up with all others in reach; up and down count that.
    """
    ends, n = edges(word, prob, longest), len(word)
    a, up = [1.0] + [0.0] * n, [0] * (n + 1)
    for j, ps in enumerate(ends, 1):
        up[j] = up[j - 1]
        a[j] = sum(a[i] * prob.get(p, UNKNOWN) for i, p in ps)
        if a[j] < 1e-100:
            for k in range(max(0, j - longest + 1), j + 1):
                a[k] *= 1e100
                up[k] += 1
    b, down = [0.0] * n + [1.0], 0
    out: dict[str, float] = {}
    for j in range(n, 0, -1):
        if b[j] and b[j] < 1e-100:
            for k in range(max(0, j - longest + 1), j + 1):
                b[k] *= 1e100
            down += 1
        for i, p in ends[j - 1]:
            v = prob.get(p, UNKNOWN)
            b[i] += b[j] * v
            if p is not None:
                d = up[n] - up[i] - down
                out[p] = out.get(p, 0.0) + a[i] * v * b[j] / a[n] * (10.0 ** (100 * d) if d else 1.0)
    return out


class Scorer:
    """Log-likelihoods of words under k languages, all segmentations summed, for many words at once."""

    def __init__(self, model: dict[str, tuple], k: int):
        self.k, pieces = k, sorted(model)
        self.longest = max(map(len, pieces), default=1)
        code = np.array([self.hash_of(p) for p in pieces], dtype=np.uint64)
        order = np.argsort(code)
        self.codes = code[order]
        self.prob = np.array([model[pieces[i]] for i in order], dtype=float).reshape(len(pieces), k)
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[self.codes >> np.uint64(42)] = True
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, k))

    @staticmethod
    def hash_of(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + (ord(c) * 0xD6E8FEB86659FD93 ^ ord(c) << 32)) & 0xFFFFFFFFFFFFFFFF
        return h

    def forward(self, words: list[str]) -> np.ndarray:
        """A row of k log-likelihoods for each word; words are as long as the longest of them, padded."""
        v, n = len(words), max(map(len, words))
        size = np.array([len(w) for w in words])
        c = np.array(words, dtype=f"<U{n}").view(np.uint32).reshape(v, n).astype(np.uint64)
        with np.errstate(over="ignore"):
            c = c * np.uint64(0xD6E8FEB86659FD93) ^ c << np.uint64(32)
            power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(self.longest, BASE))])
            head = np.zeros((n + 1, v), dtype=np.uint64)  # hashes of the first j characters
            for j in range(n):
                head[j + 1] = head[j] * BASE + c[:, j]
            a = np.zeros((n + 1, v, self.k))
            a[0] = 1.0
            log, out = np.zeros((v, self.k)), np.zeros((v, self.k))
            for j in range(1, n + 1):
                found = np.zeros(v, dtype=bool)
                for i in range(max(0, j - self.longest), j):
                    h = head[j] - head[i] * power[j - i]
                    at = np.flatnonzero(self.maybe[h >> np.uint64(42)])
                    if len(at):
                        p = np.minimum(np.searchsorted(self.codes, h[at]), len(self.codes) - 1)
                        hit = self.codes[p] == h[at]
                        at, p = at[hit], p[hit]
                        a[j, at] += a[i, at] * self.prob[p]
                        found[at] = True
                lost = np.flatnonzero(~found)
                a[j, lost] = a[j - 1, lost] * UNKNOWN
                if j % 16 == 0:  # rescale the part of the table still in reach
                    reach = slice(max(0, j - self.longest + 1), j + 1)
                    top = np.maximum(a[reach].max(axis=0), 1e-300)
                    a[reach] /= top
                    log += np.log(top)
                done = size == j
                if done.any():
                    out[done] = log[done] + np.log(np.maximum(a[j, done], 1e-300))
        return out

    def learn(self, words: list[str]) -> None:
        """Remember the rows of new words."""
        by_size = sorted(words, key=len)
        rows, at = [], 0
        while at < len(by_size):  # words of like length together, at most about a million characters
            n = len(by_size[at]) + 1
            end = at + 1
            while end < len(by_size) and len(by_size[end]) < n + 4 and (end - at) * (n + 4) < 1 << 18:
                end += 1
            rows.append(self.forward(["▁" + w for w in by_size[at:end]]))
            at = end
        first = len(self.rows)
        self.rows = np.concatenate([self.rows, *rows])
        self.known.update(zip(by_size, range(first, first + len(by_size))))

    def totals(self, texts: list[list[str]]) -> np.ndarray:
        """Summed log-likelihoods of lists of words."""
        if len(self.known) > CACHE:
            self.known, self.rows = {}, np.zeros((0, self.k))
        new = set().union(*texts).difference(self.known)
        if new:
            self.learn(list(new))
        at = self.known.__getitem__
        return np.array([self.rows[list(map(at, t))].sum(axis=0) if t else np.zeros(self.k) for t in texts]).reshape(len(texts), self.k)


def fit(docs: DataFrame, vocab_path: str, max_rows: int = 2000, rounds: int = 2) -> tuple[list[str], dict[str, tuple]]:
    """Per-language piece probabilities by expectation maximisation.

    Learns from at most `max_rows` labelled documents of each language, those
    of lowest hash among documents that are not held out; all their letter
    runs count, of any length. Rows without id, language or text are not
    learned from; an empty table gives no language. Languages x vocabulary
    bounds what comes to the driver.
    """
    vocab = vocabulary(vocab_path)
    longest = max(map(len, vocab))
    pool = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    ids = pool.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    few = ids.join(F.broadcast(ids.groupBy("lang").count()), "lang").where(f"(h / pow(2D, 64) + 0.5) * count <= {4 * max_rows}")  # holds the lowest; one row a language
    first = few.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(f"k <= {max_rows}")
    rows = pool.select("doc_id", "lang", "text").join(F.broadcast(first.select("lang", "doc_id")), ["lang", "doc_id"], "left_semi")  # at most max_rows ids a language

    def count(b):
        n = Counter((lang, w) for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist()) for w in words_of(text))
        return [k[0] for k in n], [k[1] for k in n], list(n.values())

    words = per_batch(rows.select("lang", "text"), count, "lang string, w string, n long").groupBy("lang", "w").agg(F.sum("n").alias("count")).cache()
    start = {p: 1.0 / len(vocab) for p in vocab}
    models: dict[str, dict[str, float]] = {}
    for _ in range(rounds):
        now = docs.sparkSession.sparkContext.broadcast(dict(models))

        def step(frames):
            got: dict = {}
            for f in frames:
                for lang, w, n in zip(f["lang"], f["w"], f["count"]):
                    for p, v in expected("▁" + w, now.value.get(lang, start), longest).items():
                        got[lang, p] = got.get((lang, p), 0.0) + v * n
            yield pd.DataFrame([(*k, v) for k, v in got.items()], columns=["lang", "p", "v"])

        table_ = words.mapInPandas(step, "lang string, p string, v double").groupBy("lang", "p").agg(F.sum("v").alias("v")).toPandas()
        models = {}
        for lang, part in table_.groupby("lang"):
            total = part["v"].sum() + 0.01 * len(vocab)
            got = dict(zip(part["p"], part["v"]))
            models[lang] = {p: (got.get(p, 0.0) + 0.01) / total for p in vocab}
    words.unpersist()
    langs = sorted(models)
    return langs, {p: tuple(models[x][p] for x in langs) for p in vocab} if langs else {}


def predict(docs: DataFrame, langs: list[str], model: dict[str, tuple], keep=("doc_id",), out=("lang_pred", "score")) -> DataFrame:
    """The columns `keep` of docs with the predicted language and its score, named by `out`, for every whole text.

    Null text, text without letters, or a model without languages gives `und`
    and score 0. Equal likelihoods go to the first language by name. Repeated
    rows are judged one by one, null ids like others, and an empty table gives
    none. A long text is judged whole; its words count as often as they stand.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    k, names, key = len(langs), list(keep), uuid.uuid4().hex
    read = names if "text" in names else [*names, "text"]
    schema = docs.select(*names).schema.add(out[0], "string").add(out[1], "double")

    def run(batches):
        scorer = kept(key, lambda: Scorer(shared.value, k)) if k else None
        for b in slices(batches):
            texts = [words_of(t) for t in b["text"].to_pylist()]
            got, score = ["und"] * len(texts), [0.0] * len(texts)
            if scorer:
                total = scorer.totals(texts)
                best = total.argmax(axis=1)
                share = 1 / np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -700)).sum(axis=1)
                for i, t in enumerate(texts):
                    if t:
                        got[i], score[i] = langs[best[i]], float(share[i])
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), pa.array(got, pa.string()), pa.array(score, pa.float64())], names=[*names, *out])

    return map_batches(docs.select(*read), run, schema)


def op2_language(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = predict(docs, *fit(docs, public_tokenizers.path("piece_bpe_32k.model")))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
