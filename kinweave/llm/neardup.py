"""Near copies by Order MinHash, verified by a banded alignment of words."""
from __future__ import annotations

import re
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, as_batch, drop, hash_words, map_batches, mix, ngram_hashes, per_batch, release, slices, table, written

K = 5
SKETCHES = 32
#: Buckets of up to so many texts are compared whole in one task.
SMALL = 256
#: About so many texts of a larger bucket are compared with as many others in one task.
BLOCK = 1024
#: Two texts are near copies if their word edit distance is at most 1 - this of the longer one's words.
THRESHOLD = 0.8
TOKEN = re.compile(r"[^\W_]+")
SEEDS, MORE = (mix(np.arange(1, 2 * SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)).reshape(2, -1)


def shingle_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of five-word shingles; a shorter text is one shingle."""
    return ngram_hashes(h, min(K, len(h))) if len(h) else h


def two_smallest(values: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """For each odd factor, the places of the smallest and next product; equal places for a single value."""
    out, step = [], max(1, (1 << 21) // len(values))
    for at in range(0, len(factors), step):
        with np.errstate(over="ignore"):
            v = values * factors[at:at + step, None]
        one = v.argmin(axis=1)
        v[np.arange(len(v)), one] = np.uint64(0xFFFFFFFFFFFFFFFF)
        out.append(np.stack([one, v.argmin(axis=1) if len(values) > 1 else one], axis=1))
    return np.concatenate(out)


def order_minhash(h: np.ndarray) -> list[int]:
    """SKETCHES hashes, each of two minimum occurrence-labelled k-mers in text order and one minimum distinct k-mer.

    The distinct one keeps texts apart that share little but one k-mer repeated
    very often, whose labelled occurrences would fill both sketches.
    """
    k = shingle_hashes(h)
    order = np.argsort(k, kind="stable")
    s = k[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    label = labels(order, first)
    step = max(1, (1 << 21) // len(k))
    with np.errstate(over="ignore"):
        marked, distinct = mix(k + label * np.uint64(0xD6E8FEB86659FD93)), mix(~s[first])
        x = SEEDS
        for part in marked[np.sort(two_smallest(marked, SEEDS), axis=1)].T:
            x = mix(x * np.uint64(31) + part)
        one = np.concatenate([distinct[(distinct * MORE[at:at + step, None]).argmin(axis=1)] for at in range(0, SKETCHES, step)])
        x = mix(x * np.uint64(31) + one)
    return x.astype(np.int64).tolist()


def labels(order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How often each value stands before its place; order sorts the values stably, first marks the first of equal ones."""
    start = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    label = np.empty(len(order), dtype=np.uint64)
    label[order] = (np.arange(len(first)) - start).astype(np.uint64)
    return label


def bag(w: np.ndarray) -> np.ndarray:
    """Distinct values that stand for the words of a text with their occurrence numbers."""
    order = np.argsort(w, kind="stable")
    s = w[order]
    with np.errstate(over="ignore"):
        return np.sort(mix(w + labels(order, np.concatenate([[True], s[1:] != s[:-1]])) * np.uint64(0xD6E8FEB86659FD93)))


def banded(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance of word sequences where it is at most `most`, in a band of that half-width, a column in the bits of one integer.

    Bit p of column j is row j - most + p of the table. up and down mark where
    the value rises or falls from the row above; what lies outside the band is
    taken as one higher than its neighbour within, so no value is too small.
    Along the diagonal that ends in the last cell values never fall.
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    where: dict = {}
    for i, c in enumerate(a.tolist()):
        where[c] = where.get(c, 0) | 1 << i
    full, last = (1 << 2 * most + 1) - 1, 1 << 2 * most
    up, down = ((1 << most) - 1) << most + 1, 0
    end, found = 1 << n - m + most, max(n - m, 0)
    for j, c in enumerate(b.tolist()):
        same = where.get(c, 0)
        same = (same >> j - most if j >= most else same << most - j) & full
        up, down = up >> 1 | last, down >> 1
        same |= down
        level = ((same & up) + up ^ up | same) & full
        right, left = (down | full & ~(level | up)) << 1 | 1, (up & level) << 1
        up, down = (left | ~(level | right)) & full, right & level
        found += not level & end
        if found > most:
            return None
    return found


def distance_within(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance of word sequences where it is at most `most`; narrow bands are tried first."""
    n = min(len(a), len(b))
    bad = np.flatnonzero(a[:n] != b[:n])
    lo = int(bad[0]) if len(bad) else n
    bad = np.flatnonzero(a[::-1][:n - lo] != b[::-1][:n - lo])
    hi = int(bad[0]) if len(bad) else n - lo
    a, b = a[lo:len(a) - hi], b[lo:len(b) - hi]
    width = 15
    while width < most:
        d = banded(a, b, width)
        if d is not None:
            return d
        width *= 8
    return banded(a, b, most)


def most_edits(n: int, m: int, threshold: float) -> int:
    return int((1 - threshold) * max(n, m) + 1e-9)


def alike(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """Edit similarity of words, 1 - distance / longer length, at least threshold."""
    return distance_within(a, b, most_edits(len(a), len(b), threshold)) is not None


def shared(x: list[np.ndarray], y: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Counts of values in common, for each of x and each of y, lists of distinct values."""
    sides = [(len(s), np.repeat(np.arange(len(s)), [len(v) for v in s]), np.concatenate(s)) for s in (x, y)]
    common = np.intersect1d(sides[0][2], sides[1][2])
    out = np.zeros((len(x), len(y)), dtype=np.float32)
    for c in range(0, len(common), columns):
        part, both = common[c:c + columns], []
        for n, row, v in sides:
            m = np.zeros((n, len(part)), dtype=np.float32)
            at = np.minimum(np.searchsorted(part, v), len(part) - 1)
            ok = part[at] == v
            m[row[ok], at[ok]] = 1
            both.append(m)
        out += both[0] @ both[1].T
    return out.astype(np.int64)


def links_between(reps: list[int], words: list[np.ndarray], label: list[int], first: int, threshold: float) -> list[tuple[int, int]]:
    """Links that join all like texts, of the first `first` and the others, or of all if these are all; texts of one label are joined already.

    Two texts are aligned where they have so many words in common that the
    alignment can succeed: an edit distance is never under the longer length
    less the words in common.
    """
    bags = [bag(w) for w in words]
    start = first if first < len(reps) else 0
    size, label, out = np.array([len(s) for s in bags]), np.unique(label, return_inverse=True)[1], []
    longer = np.maximum(size[:first, None], size[start:])
    like = longer - shared(bags[:first], bags[start:]) <= ((1 - threshold) * longer + 1e-9).astype(np.int64)
    for i in range(first):
        for j in (start + np.flatnonzero(like[i] & (label[start:] != label[i]))).tolist():
            if label[i] != label[j] and alike(words[i], words[j], threshold):
                out.append((reps[i], reps[j]))
                label[label == label[j]] = label[i]
    return out


def components(edges: DataFrame) -> DataFrame:
    """(id, class_id) of edges (u, v): the smallest id that links reach, by large and small stars."""
    spark, held, old = edges.sparkSession, [], []
    e = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges", held)
    before = None
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        big = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m"))
        old, held = held, []
        e = written(small.where("u <> v").distinct(), "edges", held)
        drop(spark, old)
        now = e.agg(F.count("*"), F.sum(F.expr("cast(xxhash64(u, v) as decimal(38, 0))"))).first()
        if now == before:
            return e.select(F.col("u").alias("id"), F.col("v").alias("class_id"))
        before = now


def labelled(ids: DataFrame, links: DataFrame, held: list | None = None) -> DataFrame:
    """(rep, c): the smallest id that links reach, for every id of the column rep."""
    found = ids.join(components(links), F.col("rep") == F.col("id"), "left")
    return written(found.select("rep", F.coalesce("class_id", "rep").alias("c")), "classes", held)


def by_group(rows: DataFrame, key: list[str], f, schema: str) -> DataFrame:
    """What f gives for the rows of each key, as lists of dicts. Each task streams its keys in order and holds one of them."""
    names = rows.columns

    def run(batches):
        release()
        each = (r for b in slices(batches, 1024) for r in zip(*(c.to_pylist() for c in b.columns)))
        at, kinds, out = [names.index(k) for k in key], arrow_schema(schema), []
        for _, group in groupby(each, lambda r: tuple(r[k] for k in at)):
            out += f([dict(zip(names, r)) for r in group])
            if len(out) > 4096:
                yield as_batch(list(zip(*out)), kinds)
                out = []
        if out:
            yield as_batch(list(zip(*out)), kinds)

    return map_batches(rows.repartition(*key).sortWithinPartitions(*key), run, schema)


def found_classes(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, h1, h2, k1, k2) of every row and (k1, k2, class_key, class_id) of every text with words.

    k1 and k2 name a word sequence, h1 and h2 a whole text; class_key is unique to a class.
    """
    spark, held = docs.sparkSession, []

    def sketch(b):
        out = []
        for text in b["text"].to_pylist():
            h = hash_words(TOKEN.findall((text or "").lower()))
            if len(h):
                key = ngram_hashes(np.concatenate([h, [np.uint64(len(h))]]), 1)
                with np.errstate(over="ignore"):
                    at = np.arange(1, len(h) + 2, dtype=np.uint64)
                    pair = [int((mix(key ^ mix(at + np.uint64(s)))).sum(dtype=np.uint64).astype(np.int64)) for s in (0, 1 << 40)]
                out.append((*pair, order_minhash(h), (h >> np.uint64(32)).astype("<u4").tobytes()))
            else:
                out.append((None, None, None, None))
        return [b["doc_id"], b["h1"], b["h2"], *zip(*out)]

    rows = docs.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2"), "text")
    base = written(per_batch(rows, sketch, "doc_id long, h1 long, h2 long, k1 long, k2 long, s array<long>, w binary"), "sketches")
    reps = base.where("k1 is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("low"), F.first("s").alias("s"))
    reps = written(reps.withColumn("rep", F.monotonically_increasing_id()), "texts", held)
    left = reps.select("rep", F.posexplode("s").alias("j", "s"))
    many = left.groupBy("j", "s").agg(F.count("*").alias("n")).where("n > 1")
    left = written(left.join(written(many, "sizes", held), ["j", "s"]), "buckets", held)
    met = reps.select("k1", "k2", "rep").join(left.select("rep").distinct(), "rep", "left_semi")
    words = written(base.select("k1", "k2", "w").join(met, ["k1", "k2"]).select("rep", "w").dropDuplicates(["rep"]), "words", held)

    def compare(group):
        group.sort(key=lambda r: r["rep"])
        reps = [r["rep"] for r in group]
        return links_between(reps, [of_bytes(r["w"]) for r in group], reps, len(group), threshold)

    def compare_cell(group):
        group.sort(key=lambda r: (r["side"], r["rep"]))
        first = sum(r["side"] == 0 for r in group)
        if not first:
            return []
        c = {r["rep"]: r["c"] for r in group}
        got = links_between([r["rep"] for r in group], [of_bytes(r["w"]) for r in group], [r["c"] for r in group], first, threshold)
        return [(c[u], c[v]) for u, v in got]

    part = F.expr(f"case when n > {SMALL} then pmod(xxhash64(rep, j), ceil(n / {SMALL})) else 0 end").alias("part")
    sets = left.groupBy("j", "s", part).agg(F.sort_array(F.collect_list("rep")).alias("reps")).select("reps").where("size(reps) > 1").distinct()  # about SMALL reps each
    member = sets.select(F.xxhash64("reps").alias("id"), F.explode("reps").alias("rep"))
    found = labelled(reps.select("rep"), by_group(member.join(words, "rep"), ["id"], compare, "u long, v long"), held)
    hot = written(left.where(f"n > {SMALL}").drop("n").join(found, "rep"), "hot", held)
    size = hot.groupBy("j", "s", "c").agg(F.count("*").alias("n"))
    home = size.groupBy("j", "s").agg(F.max(F.struct("n", "c")).alias("m"), F.sum("n").alias("n")).where("m.n < n")
    home = home.select("j", "s", F.col("m.c").alias("home"), F.expr(f"ceil(m.n / {BLOCK})").alias("hs"), F.expr(f"ceil((n - m.n) / {BLOCK})").alias("xs"))
    cells = hot.join(written(home, "homes", held), ["j", "s"])
    if not cells.isEmpty():
        # blocks of texts outside the largest class count from 0, those in it from -1 down; a cell (x, y) compares a block x >= 0 with one y <= x
        own = "pmod(xxhash64(rep, j), xs)"
        at = f"""case when c = home then transform(sequence(0, xs - 1), x -> struct(x as x, -1 - pmod(xxhash64(rep, j), hs) as y, 1 as side))
            else transform(sequence(-hs, xs - 1), b -> struct(greatest(b, {own}) as x, least(b, {own}) as y, if(b <= {own}, 0, 1) as side)) end"""
        cells = cells.select("j", "s", "rep", "c", F.explode(F.expr(at)).alias("at")).select("j", "s", "rep", "c", "at.x", "at.y", "at.side")
        more = by_group(cells.join(words, "rep"), ["j", "s", "x", "y"], compare_cell, "u long, v long")
        again = labelled(found.select(F.col("c").alias("rep")).distinct(), more, held).toDF("c", "d")
        found = found.join(again, "c").select("rep", F.col("d").alias("c"))
    found = reps.select("k1", "k2", "low", "rep").join(found, "rep")
    found = found.join(found.groupBy("c").agg(F.min("low").alias("class_id")), "c").select("k1", "k2", F.col("c").alias("class_key"), "class_id")
    found = written(found, "found")
    drop(spark, held)
    return base.select("doc_id", "h1", "h2", "k1", "k2"), found


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, class_key) for every row; class_id is the smallest doc_id of its near copies.

    Near copies have a word edit similarity of at least `threshold`. Equal word
    sequences are one text from the start. Texts that share a sketch are a
    bucket, and like texts of a bucket end in one class, whatever its size.
    Parts of up to about SMALL texts are compared whole in one task; equal parts
    are dealt with once. A larger bucket is dealt into such parts first, each
    sketch another way; then every text outside its largest class is compared
    with all of the bucket that other classes hold, by blocks of about BLOCK.
    Null or empty texts are alike to nothing: they keep their own id, and have no
    class_key. Very long texts are compared whole. Repeated rows get the same
    class. Rows of one id with other texts get the class of each text; classes
    whose smallest id is the same one are told apart by class_key, a number that
    no other class of the same call has. Rows with a null id belong to classes
    like others, but name none. An empty table gives no rows; other columns are
    not read.
    """
    base, found = found_classes(docs, threshold)
    return base.join(found, ["k1", "k2"], "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "class_key")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that stay when one of each class does: that of smallest id, then of smallest text hash; null ids come last.

    Rows with null or empty text stay, once where a row repeats: rows of equal id
    and text are one. All columns are kept, whatever their names.
    """
    base, found = found_classes(docs, threshold)
    mine = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "h1", "h2")
    first = base.join(found, ["k1", "k2"]).groupBy("class_key").agg(F.min(mine).alias("m")).select("m.doc_id", "m.h1", "m.h2")
    stay = first.union(base.where("k1 is null").select("doc_id", "h1", "h2")).select(F.xxhash64("doc_id", "h1", "h2").alias("__a"), F.xxhash64("h2", "doc_id", "h1").alias("__b")).distinct()
    h1, h2 = F.xxhash64("text"), F.xxhash64("text", F.lit(1))
    rows = docs.withColumns({"__a": F.xxhash64("doc_id", h1, h2), "__b": F.xxhash64(h2, "doc_id", h1)})
    return rows.join(stay, ["__a", "__b"], "left_semi").dropDuplicates(["__a", "__b"]).select(*docs.columns)


def of_bytes(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<u4").astype(np.uint64)


def op8_neardup(spark, sf_dir) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
