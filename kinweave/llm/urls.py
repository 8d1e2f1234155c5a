"""URL rules, then naive Bayes over words that a unigram Viterbi finds in hosts and paths."""
from __future__ import annotations

import json
import math
import re
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, as_batch, table

#: Verdict, host and path of the rules.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
BUCKETS = 1 << 16


def split_url(url):
    """Columns for host and path; both empty where url is null or has no `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.expr("substr(url, instr(url, '://') + 3)"), "#", 1)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1)
    return host, path


def with_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and its verdict (null where none fits)."""
    host, path = split_url(F.col("url"))
    df = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tried last and wins
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return df.withColumns({"rule": rule, "by_rule": verdict})


def lexicon(path: str) -> dict[str, float]:
    """Log probabilities of letter pieces of a public vocabulary, of any script and length, by rank."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words: dict[str, int] = {}
    for w, i in sorted(vocab.items(), key=lambda x: x[1]):
        w = w.lstrip("ĠĊ▁").removesuffix("</w>").lower()
        if len(w) > 1 and w.isalpha():
            words.setdefault(w, len(words))
    total = sum(1 / (r + 10) for r in words.values())
    return {w: math.log(1 / (r + 10) / total) for w, r in words.items()}


def segment(name: str, words: dict[str, float], longest: int) -> list[str]:
    """Most probable split of a concatenated name (Viterbi); unknown letters stand alone. Of equal splits the one with the shorter last word wins, at every place."""
    best = [(0.0, 0)]
    for j in range(1, len(name) + 1):
        best.append(max((best[i][0] + words.get(name[i:j], -18.0 if j - i == 1 else -math.inf), i) for i in range(max(0, j - longest), j)))
    out, j = [], len(name)
    while j:
        out.append(name[best[j][1]:j])
        j = best[j][1]
    return out[::-1]


class Tokens:
    """Marked tokens of host labels and path parts; digits keep only their count. `without` are tokens left out."""

    def __init__(self, words: dict[str, float], without=frozenset()):
        self.words, self.without, self.longest, self.cache = words, without, max(map(len, words), default=1), {}

    def of(self, host: str, path: str) -> list[str]:
        out = []
        for mark, text in (("h:", host), ("p:", path.lower())):
            for part in re.findall(r"[^\W\d_]+|\d+", text):
                if part.isdigit():
                    out.append(f"{mark}#{len(part)}")
                    continue
                if part not in self.cache:
                    if len(self.cache) > 100_000:
                        self.cache.clear()
                    self.cache[part] = segment(part, self.words, self.longest)
                out += [mark + w for w in self.cache[part]]
        return [t for t in out if t not in self.without]


def rule_tokens(words: dict[str, float], rules=RULES) -> frozenset[str]:
    """Tokens that the rules themselves match on: they say which rule fits, not what a page is like."""
    t = Tokens(words)
    return frozenset(x for _, host, path in rules for x in t.of(host, path))


def classify(ruled: DataFrame, words: dict[str, float], rules=RULES, buckets: int = BUCKETS) -> DataFrame:
    """Verdicts for all rows: the rule's, else that of naive Bayes learned from all ruled rows.

    Labels are the rules' verdicts, as no table has others; so tokens that rules
    match on are no evidence, and both classes have equal weight, whatever
    share of rows rules block. Token counts are kept in `buckets` hashed cells. A
    row with no evidence is allowed: null urls, urls without `://`, and all rows
    without a rule where rules give fewer than two classes; so are even odds.
    Very long urls are read whole; repeated rows and null ids are judged each; an
    empty table gives no rows; other columns are not read.
    """
    spark = ruled.sparkSession
    lex = spark.sparkContext.broadcast((words, rule_tokens(words, rules)))

    def cells(t, host, path):
        return [zlib.crc32(x.encode()) % buckets for x in t.of(host, path)]

    def count(batches):
        n, t = np.zeros((2, buckets + 1), dtype=np.int64), Tokens(*lex.value)
        for b in batches:
            for host, path, v in zip(*(b[c].to_pylist() for c in ("host", "path", "by_rule"))):
                row = n[int(v == "block")]
                row[buckets] += 1
                for c in cells(t, host, path):
                    row[c] += 1
        at = np.flatnonzero(n.sum(axis=0))
        yield as_batch([at, n[0, at], n[1, at]], arrow_schema("b long, allow long, block long"))

    got = ruled.where("by_rule is not null").mapInArrow(count, "b long, allow long, block long").groupBy("b").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).toPandas()
    n = np.zeros((2, buckets + 1))
    n[:, got["b"].to_numpy(dtype=int)] = got[["allow", "block"]].to_numpy(dtype=float).T
    both = bool((n[:, buckets] > 0).all())
    p = (n[:, :buckets] + 0.1) / (n[:, :buckets].sum(axis=1, keepdims=True) + 0.1 * buckets)
    odds = spark.sparkContext.broadcast(np.log(p[1] / p[0]) if both else np.zeros(buckets))
    schema = "page_id long, host string, path string, rule string, verdict string, score double"

    def judge(batches):
        t = Tokens(*lex.value)
        for b in batches:
            s = [float(odds.value[cells(t, h, q)].sum()) for h, q in zip(b["host"].to_pylist(), b["path"].to_pylist())]
            verdict = [v or ("block" if x > 0 else "allow") for v, x in zip(b["by_rule"].to_pylist(), s)]
            yield as_batch([b["page_id"], b["host"], b["path"], b["rule"], verdict, s], arrow_schema(schema))

    return ruled.mapInArrow(judge, schema)


def op3_urls(spark, sf_dir) -> DataFrame:
    return classify(with_rules(table(spark, sf_dir, "pages")), lexicon(public_tokenizers.path("word_bpe_49k.json")))
