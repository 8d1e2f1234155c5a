"""Similarities of pairs in [0, 1]; two empty sides are alike, one empty side is not, unless said otherwise."""
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _either(empty_a, empty_b, value):
    return F.when(empty_a & empty_b, 1.0).when(empty_a | empty_b, 0.0).otherwise(value)


def jaccard(a, b):
    return _either(F.size(a) == 0, F.size(b) == 0, F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))))


def overlap(a, b):
    return _either(F.size(a) == 0, F.size(b) == 0, F.try_divide(F.size(F.array_intersect(a, b)), F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))))


def containment(a, b):
    """Share of a's elements that b has."""
    return _either(F.size(a) == 0, F.size(b) == 0, F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_distinct(a))))


def numeric_tokens(a):
    return F.filter(a, lambda t: t.rlike(r"\p{Nd}"))


def length_ratio(a, b):
    return _either(a == "", b == "", F.try_divide(F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))))


def exact(a, b):
    return ((a != "") & (a == b)).cast("double")


def _codes(texts: list[str]) -> np.ndarray:
    """Code points by row, 0 beyond the end."""
    n = max(map(len, texts), default=0)
    return np.array(texts, dtype=f"<U{max(n, 1)}").view(np.uint32).reshape(len(texts), -1)


class Texts:
    """Distinct texts, with what pairs of them are compared by, made when first asked for."""

    def __init__(self, texts: list[str]):
        self.texts, self.size, self.counted = texts, np.array([len(t) for t in texts], dtype=np.int64), {}

    @cached_property
    def codes(self) -> tuple[np.ndarray, int]:
        """Characters by row as small numbers, 0 beyond the end, and a number that none has."""
        x = _codes(self.texts)
        seen = np.zeros(int(x.max(initial=0)) + 1, dtype=bool)
        seen[x] = True
        seen[0] = False
        number = np.cumsum(seen)
        n = int(number[-1]) + 1
        return np.where(seen, number, 0).astype(np.uint8 if n < 256 else np.uint32)[x], n

    @cached_property
    def tokens(self) -> "Tokens":
        """Those between spaces."""
        lists = [t.split(" ") if t else [] for t in self.texts]
        return self.words[1] if lists == self.split else Tokens(lists)

    @cached_property
    def split(self) -> list[list[str]]:
        """Tokens between white space."""
        return [t.split() for t in self.texts]

    @cached_property
    def in_order(self) -> tuple["Texts", np.ndarray]:
        texts, place = _places([" ".join(sorted(t)) for t in self.split])
        return Texts(texts), place

    @cached_property
    def words(self) -> tuple["Texts", "Tokens"]:
        """The distinct tokens between white space in order, each with a space after it."""
        sets = [sorted(set(t)) for t in self.split]
        return Texts([" ".join(t) + " " if t else "" for t in sets]), Tokens(sets)

    @cached_property
    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct character 3-grams of ^text$ as numbers, those of a text together, and how many each text has."""
        text = [f"^{t}$" if t else "" for t in self.texts]
        size = np.array([len(t) for t in text], dtype=np.int64)
        h = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        row = np.repeat(np.arange(len(text)), size)
        ok = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.zeros(0, dtype=np.int64)
        known, h = np.unique(h, return_inverse=True)
        bits = max(1, len(known).bit_length())
        g, row, out = h[ok] << 2 * bits | h[ok + 1] << bits | h[ok + 2], row[ok], []
        step = 1 << min(32, 63 - 3 * bits)
        edge = np.searchsorted(row, np.arange(0, len(text) + step, step))
        for first, (lo, hi) in zip(range(0, len(text), step), zip(edge[:-1], edge[1:])):
            key = np.sort((row[lo:hi] - first) << 3 * bits | g[lo:hi])
            key = key[np.diff(key, prepend=-1) != 0]
            out.append((key & (1 << 3 * bits) - 1, (key >> 3 * bits) + first))
        g, row = (np.concatenate([x[k] for x in out]) if out else np.zeros(0, dtype=np.int64) for k in (0, 1))
        return g, np.bincount(row, minlength=len(text))


class Tokens:
    """Distinct tokens of texts by number."""

    def __init__(self, lists: list[list[str]]):
        known, flat, row = {}, [], []
        for k, tokens in enumerate(lists):
            if len(set(tokens)) < len(tokens):
                tokens = dict.fromkeys(tokens)
            flat += [known.setdefault(t, len(known)) for t in tokens]
            row.append(len(tokens))
        self.known, self.id, self.count = list(known), np.array(flat, dtype=np.int64), np.array(row, dtype=np.int64)
        self.begin = np.cumsum(self.count) - self.count
        self.row = np.repeat(np.arange(len(lists)), self.count)

    @cached_property
    def size(self) -> np.ndarray:
        """Characters of each token of each text."""
        return np.array([len(t) for t in self.known], dtype=np.int64)[self.id]

    @cached_property
    def numeric(self) -> np.ndarray:
        """Of each token of each text, whether it has a digit."""
        return np.array([not t.isalpha() and any(map(str.isdecimal, t)) for t in self.known], dtype=bool)[self.id]

    def common(self, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens that texts p and q have in common: the pair, and where each of the two has it; by pair."""
        if not len(self.id) or not len(p):
            return (np.zeros(0, dtype=np.int64),) * 3
        wide, mine = len(self.known), np.unique(p)
        here = np.repeat(self.begin[mine] - np.cumsum(self.count[mine]) + self.count[mine], self.count[mine]) + np.arange(self.count[mine].sum())
        key = self.row[here] * wide + self.id[here]
        order = np.argsort(key)
        here, key = here[order], key[order]
        n = self.count[q]
        pair, there = np.repeat(np.arange(len(q)), n), np.repeat(self.begin[q] - np.cumsum(n) + n, n) + np.arange(n.sum())
        wanted = p[pair] * wide + self.id[there]
        at = np.minimum(np.searchsorted(key, wanted), max(len(key) - 1, 0))
        hit = np.flatnonzero(key[at] == wanted) if len(key) else np.zeros(0, dtype=np.int64)
        return pair[hit], here[at[hit]], there[hit]


def _places(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Distinct texts, and the place of each text there."""
    place = {t: k for k, t in enumerate(dict.fromkeys(texts))}
    return list(place), np.array([place[t] for t in texts], dtype=np.int64)


def _shared_first(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides of pairs, that of fewer distinct texts first."""
    return (p, q) if len(np.unique(p)) <= len(np.unique(q)) else (q, p)


def _step(s: list[np.ndarray], m) -> None:
    """One character of the other text: the row of the subsequence table in the bits of s, word by word with carry."""
    if len(s) == 1:
        u = s[0] & m[0]
        s[0] = (s[0] + u) | (s[0] - u)
        return
    carry = np.uint64(0)
    for w, x in enumerate(s):
        u = x & m[w]
        total = x + u
        over = total < x
        total += carry
        carry = (over | (total < carry)).astype(np.uint64)
        s[w] = total | (x - u)


def _lcs(t: Texts, p: np.ndarray, q: np.ndarray, kept=None, gone=None, rows: int = 16384) -> np.ndarray:
    """Lengths of the longest common subsequences of texts p and q, many pairs at once; pairs with one text p share its bits.

    Of p's characters only those count whose bits are in `kept` (word, pair), of q's those not in `gone` (pair, place).
    """
    out, (codes, n), words = np.zeros(len(p), dtype=np.int64), t.codes, np.maximum(-(-t.size // 64), 1)
    order = np.lexsort((p, words[p]))
    rows = max(1, min(rows, (1 << 22) // (n * int(words[p].max(initial=1)))))
    for at in range(0, len(p), rows):
        pick = order[at:at + rows]
        pick = pick[np.argsort(t.size[q[pick]], kind="stable")[::-1]]
        mine, row = np.unique(p[pick], return_inverse=True)
        x, y, begin = codes[mine], codes[q[pick]], np.arange(len(mine)) * n
        if gone is not None:
            y *= ~gone[pick]
        # the places of each character in a text, as bits
        bits = np.zeros((int(words[mine].max()), len(mine) * n), dtype=np.uint64)
        for k in range(min(x.shape[1], 64 * len(bits))):
            bits[k // 64, begin + x[:, k]] |= np.uint64(1 << k % 64)
        bits[:, begin] = 0
        which, y, s = begin[row], np.ascontiguousarray(y.T), [np.full(len(pick), ~np.uint64(0)) for _ in bits]
        some = None if kept is None else [np.ascontiguousarray(w[pick]) for w in kept[:len(bits)]]
        for slot, live in zip(y, np.searchsorted(-t.size[q[pick]], -np.arange(len(y))).tolist()):
            if not live:
                break
            slot = which[:live] + slot[:live]
            now, m = [w[:live] for w in s], [w.take(slot) for w in bits]
            if some:
                m = [w & k[:live] for w, k in zip(m, some)]
            _step(now, m)
            for w, new in zip(s, now):
                w[:live] = new
        out[pick] = sum(np.bitwise_count(~w).astype(np.int64) for w in s)
    return out


def _comb(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common subsequences of every row of a and b with all windows of the other at once, by Tiskin's combing.

    A strand begins at each character and crosses the table of both texts, two
    strands at most once and never where characters agree. Gives where the
    strands that leave b, and those that leave a, begin in the same text, by
    place and row; negative if in the other one. Then a window of b holds
    length - (strands that begin and end in it) characters of a subsequence
    of all of a, and the other way round. Places that match nothing change no result.
    """
    (rows, m), n = a.shape, b.shape[1]
    kind = np.uint8 if m + n <= 256 else np.uint16 if m + n <= 65536 else np.uint32
    x, y = np.ascontiguousarray(a[:, ::-1].T), np.ascontiguousarray(b.T)
    h = np.repeat(np.arange(m, dtype=kind)[:, None], rows, axis=1)
    v = np.repeat(np.arange(m, m + n, dtype=kind)[:, None], rows, axis=1)
    same, other, mixed = np.empty((min(m, n), rows), dtype=bool), *np.empty((2, min(m, n), rows), dtype=kind)
    for t in range(m + n - 1):  # the cells of a diagonal are independent
        first, last = max(0, t - m + 1), min(t, n - 1) + 1
        i, j, k = slice(m - 1 - t + first, m - 1 - t + last), slice(first, last), last - first
        p, q, e, o, z = h[i], v[j], same[:k], other[:k], mixed[:k]
        np.not_equal(x[i], y[j], out=e)
        np.negative(e.view(np.uint8), out=o, dtype=kind)  # no bit where characters agree, else all
        np.bitwise_and(o, q, out=o)
        np.bitwise_xor(p, q, out=z)
        np.maximum(p, o, out=q)
        np.bitwise_xor(z, q, out=p)
    signed = np.int16 if m + n < 1 << 15 else np.int64
    return v.astype(signed) - signed(m), signed(m - 1) - h[::-1].astype(signed)


def _best_window(start: np.ndarray, width: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Best ratio of texts of a width with windows of it in those of a size, windows cut at the ends included; start is by `_comb`."""
    n, rows = start.shape
    width, size = width.astype(start.dtype), size.astype(start.dtype)
    place = np.arange(n, dtype=start.dtype)[:, None]
    inside = (start >= 0) & (place < start + width) & (place < size)
    # by the end of a window: strands that it holds are more by those that end there, less by those that begin before it
    held = np.zeros((n + int(width.max()) + 1, rows), dtype=start.dtype)
    held[1:n + 1] = inside
    held.reshape(-1)[np.where(inside, start + width + 1, 0).astype(np.int64) * rows + np.arange(rows)] -= 1
    held[0] = 0
    for before, now in zip(held, held[1:]):
        now += before
    end = np.arange(len(held), dtype=start.dtype)[:, None]
    length = np.maximum(np.minimum(end, size) - np.maximum(end - width, 0), 0)
    return (2 * (length - held).astype(float) / (width + length)).max(axis=0)


def _known(t: Texts, p, q) -> np.ndarray:
    """1 for equal texts, 0 where one is empty, NaN where it takes a look."""
    return np.where(p == q, 1.0, np.where((t.size[p] == 0) | (t.size[q] == 0), 0.0, np.nan))


def _indel(t: Texts, p, q) -> np.ndarray:
    """2 x common subsequence / both lengths."""
    out = _known(t, p, q)
    at = np.flatnonzero(np.isnan(out))
    p, q = _shared_first(p[at], q[at])
    out[at] = 2 * _lcs(t, p, q) / (t.size[p] + t.size[q])
    return out


def _sorted_tokens(t: Texts, p, q) -> np.ndarray:
    texts, place = t.in_order
    return _indel(texts, place[p], place[q])


def _token_sets(t: Texts, p, q) -> np.ndarray:
    """Best ratio among common tokens, and these with what only one side has."""
    out = _known(t, p, q)
    at = np.flatnonzero(np.isnan(out))
    if not len(at):
        return out
    p, q = _shared_first(p[at], q[at])
    texts, tokens = t.words
    pair, mine, theirs = tokens.common(p, q)
    long = tokens.size + 1  # with the space
    begin = np.cumsum(long) - long
    begin -= np.repeat(begin[np.minimum(tokens.begin, max(len(begin) - 1, 0))], tokens.count) if len(begin) else 0
    both = np.bincount(pair, long[mine], len(p)).astype(np.int64)
    # common tokens stand first on both sides, so only the others are compared: the common ones are left out of p's bits and of q
    kept = np.full((int(np.maximum(-(-texts.size[p] // 64), 1).max()), len(p)), ~np.uint64(0))
    gone = np.zeros((len(p), texts.codes[0].shape[1]), dtype=bool)
    for which, where, put in ((pair, mine, lambda r, c: np.bitwise_and.at(kept, (c // 64, r), ~(np.uint64(1) << (c % 64).astype(np.uint64)))), (pair, theirs, lambda r, c: gone.__setitem__((r, c), True))):
        n = long[where]
        put(np.repeat(which, n), np.repeat(begin[where] - np.cumsum(n) + n, n) + np.arange(n.sum()))
    x, y = texts.size[p] - both, texts.size[q] - both
    found = _lcs(texts, p, q, kept, gone)
    # lengths and what is found have one space more than the texts, at the end
    whole = both - 1
    best = np.where((x > 0) & (y > 0), 2 * (both + found - 1) / np.maximum(2 * both + x + y - 2, 1), np.where((both > 0) | (x == y), 1.0, 0.0))
    for size in (x, y):
        best = np.maximum(best, np.where(both > 0, 2 * whole / np.maximum(2 * whole + size, 1), 0.0))
    out[at] = best
    return out


def _partial(t: Texts, p, q, rows: int = 2048) -> np.ndarray:
    """Best ratio of the shorter text with a window of the longer; of texts of one length, each with windows of the other."""
    out = _known(t, p, q)
    at = np.flatnonzero(np.isnan(out))
    less = t.size[p[at]] <= t.size[q[at]]
    p, q = np.where(less, p[at], q[at]), np.where(less, q[at], p[at])
    order = np.lexsort((t.size[p], t.size[q]))[::-1]
    rows = max(1, min(rows, (1 << 22) // (int(t.size[q].max(initial=0)) + 1)))
    codes, n = t.codes
    for k in range(0, len(at), rows):
        pick = order[k:k + rows]
        short, long = t.size[p[pick]], t.size[q[pick]]
        x, y = codes[p[pick], :short.max()], codes[q[pick], :long.max()]
        y = np.where(y == 0, y.dtype.type(n), y)  # the end of one text isn't that of the other
        of_long, of_short = _comb(x, y)
        best = _best_window(of_long, short, long)
        even = np.flatnonzero(short == long)
        if len(even):
            best[even] = np.maximum(best[even], _best_window(of_short[:, even], long[even], short[even]))
        out[at[pick]] = best
    return out


def _share(n, a, b, of):
    """n / of, but 1 where both sides are empty and 0 where one is."""
    return np.where((a == 0) & (b == 0), 1.0, np.where((a == 0) | (b == 0), 0.0, n / np.maximum(of, 1)))


def _token_counts(t: Texts, p, q, numeric=False):
    """Common tokens of each pair, and the tokens of each side."""
    x = t.tokens
    pair, mine, _ = x.common(*_shared_first(p, q))
    if numeric:
        pair, count = pair[x.numeric[mine]], np.bincount(x.row[x.numeric], minlength=len(x.count))
    else:
        count = x.count
    return np.bincount(pair, minlength=len(p)), count[p], count[q]


def _gram_counts(t: Texts, p, q):
    """Common 3-grams of each pair, and those of each side."""
    g, count = t.grams
    i, j = _shared_first(p, q)
    h, edge = g.view(np.uint64) * _MIX, np.append(0, np.cumsum(count))  # an odd factor keeps unlike numbers unlike
    return _sums(h, np.ones(len(h)), edge, i, h, edge[:-1], count, j).astype(np.int64), count[p], count[q]


def _set_feature(counts, of):
    def run(t: Texts, p, q):
        if counts not in t.counted:  # the pairs are the same for all features
            t.counted[counts] = counts(t, p, q)
        n, a, b = t.counted[counts]
        return _share(n, a, b, of(n, a, b))

    return run


def _numeric_counts(t, p, q):
    return _token_counts(t, p, q, True)


_JACCARD, _OVERLAP = (lambda n, a, b: a + b - n), (lambda n, a, b: np.minimum(a, b))
RATIOS = {"ratio": _indel, "token_set_ratio": _token_sets, "token_sort_ratio": _sorted_tokens, "partial_ratio": _partial}
#: All that follows from two texts; the sets are those of their tokens between spaces and of their 3-grams.
COMPARED = RATIOS | {
    "jaccard": _set_feature(_token_counts, _JACCARD), "overlap": _set_feature(_token_counts, _OVERLAP), "char_ngram_jaccard": _set_feature(_gram_counts, _JACCARD),
    "token_containment_s1": _set_feature(_token_counts, lambda n, a, b: a), "token_containment_candidate": _set_feature(_token_counts, lambda n, a, b: b),
    "numeric_jaccard": _set_feature(_numeric_counts, _JACCARD), "numeric_overlap": _set_feature(_numeric_counts, _OVERLAP),
}


def compared(a: list[str], b: list[str], names) -> dict[str, np.ndarray]:
    """COMPARED by name of pairs of texts; pairs that repeat are compared once, long texts a few at a time."""
    out = {n: np.zeros(len(a)) for n in names}
    longest = np.array([max(len(x), len(y), 1) for x, y in zip(a, b)], dtype=np.int64)
    kind = np.maximum(np.ceil(np.log2(longest)).astype(np.int64), 7)
    for k in np.unique(kind).tolist():
        rows, step = np.flatnonzero(kind == k), max(1, (1 << 24) >> k)
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            texts, place = _places([a[i] for i in some.tolist()] + [b[i] for i in some.tolist()])
            pair, again = np.unique(place[:len(some)] * len(texts) + place[len(some):], return_inverse=True)
            t, p, q = Texts(texts), pair // len(texts), pair % len(texts)
            for n in names:
                out[n][some] = COMPARED[n](t, p, q)[again]
    return out


def _of_lists(name):
    return lambda a, b: compared(a, b, (name,))[name]


indel, token_sets, sorted_tokens, partial = map(_of_lists, RATIOS)


def ratios(a, b, names=tuple(RATIOS)):
    """A struct of COMPARED of two text columns, all from one pass."""
    @F.arrow_udf(", ".join(f"{n} double" for n in names))
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        out = compared(x.fill_null("").to_pylist(), y.fill_null("").to_pylist(), names)
        return pa.StructArray.from_arrays([pa.array(out[n]) for n in names], names=list(names))

    return run(a, b)


def _one(name):
    return lambda a, b: ratios(a, b, (name,))[name]


ratio, token_set_ratio, token_sort_ratio, partial_ratio = map(_one, RATIOS)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def grams(texts: list[str], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all character grams, repeats kept, and the text of each; those of one text stand together."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    h0 = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    row = np.repeat(np.arange(len(texts)), size)
    left = np.cumsum(size)[row] - np.arange(len(row))  # characters from here to the end of the text
    fits = [left[:max(0, len(row) - n + 1)] >= n for n in range(low, high + 1)]
    count = np.maximum(size[:, None] - np.arange(low, high + 1) + 1, 0)
    first = (np.cumsum(count).reshape(count.shape) - count) if count.size else count
    out, h = np.empty(int(count.sum()), dtype=np.uint64), np.zeros(len(h0), dtype=np.uint64)
    place = np.arange(len(row)) - (np.cumsum(size) - size)[row]  # of a character in its text
    with np.errstate(over="ignore"):
        for n in range(1, high + 1):
            h = (h[:max(0, len(h0) - n + 1)] + h0[n - 1:]) * _MIX
            if n >= low:
                ok = fits[n - low]
                out[(first[:, n - low][row[:len(ok)]] + place[:len(ok)])[ok]] = h[ok]
    return out, np.repeat(np.arange(len(texts)), count.sum(axis=1))


def counted(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, row), by row, and how often each occurs."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return h[at], row[at], np.diff(np.append(at, len(h)))


class Idf:
    """Weights of grams by hash: ln((1 + N) / (1 + df)) + 1; grams not listed are held by one record."""

    def __init__(self, total: int, h: np.ndarray, df: np.ndarray, low: int, high: int):
        order = np.argsort(h)
        self.h, self.w = h[order], np.log((1 + total) / (1 + df[order])) + 1
        self.rare, self.low, self.high = float(np.log((1 + total) / 2) + 1), low, high

    def vectors(self, texts: list[str]):
        """Distinct grams of texts, the text of each, how often it occurs there, and its weight."""
        h, row, tf = counted(*grams(texts, self.low, self.high))
        w = np.full(len(h), self.rare)
        if len(self.h):
            at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
            w = np.where(self.h[at] == h, self.w[at], self.rare)
        return h, row, tf, w


def tfidf_norm(text, idf):
    """Length of the vector of TF-IDF weights of a text; idf is a broadcast Idf."""
    @F.arrow_udf(DoubleType())
    def run(text: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for at in range(0, len(text), 1000):
            some = text.slice(at, 1000).fill_null("").to_pylist()
            _, row, tf, w = idf.value.vectors(some)
            out.append(np.sqrt(np.bincount(row, (tf * w) ** 2, len(some))))
        return pa.array(np.concatenate(out))

    return run(text)


def _sums(h, v, start, i, g, begin, size, j) -> np.ndarray:
    """For each pair, the sum of the values v of those numbers h of text i that are among the numbers g of text j; numbers are mixed, and each i is looked up by all its partners at once."""
    order = np.argsort(i, kind="stable")
    edge = np.searchsorted(i[order], np.arange(len(start)))
    out, table, shift = np.zeros(len(i)), np.zeros(1 << 16, dtype=np.int32), np.uint64(48)
    for k in np.unique(i).tolist():
        for part in range(edge[k], edge[k + 1], 256):
            rows = order[part:min(part + 256, edge[k + 1])]
            n = size[j[rows]]
            owner = np.repeat(np.arange(len(rows)), n)
            theirs = g[(begin[j[rows]] - np.cumsum(n) + n)[owner] + np.arange(len(owner))]
            slot, mine, value = (theirs >> shift).astype(np.int64), h[start[k]:start[k + 1]], v[start[k]:start[k + 1]]
            while len(mine):  # numbers that share a slot take a round each
                own, number = (mine >> shift).astype(np.int64), np.arange(1, len(mine) + 1, dtype=np.int32)
                table[own] = number
                at = table[slot]
                hit = np.flatnonzero(at)
                hit = hit[mine[at[hit] - 1] == theirs[hit]]
                out[rows] += np.bincount(owner[hit], value[at[hit] - 1], len(rows))
                lost = table[own] != number
                table[own] = 0
                mine, value = mine[lost], value[lost]
    return out


def _dots(few: list[str], many: list[str], i: np.ndarray, j: np.ndarray, idf: Idf) -> np.ndarray:
    """Dot products of TF-IDF vectors of few[i] and many[j]; each of few is looked up by all its partners at once."""
    h, row, tf, w = idf.vectors(few)
    g, of = grams(many, idf.low, idf.high)
    return _sums(h, tf * w * w, np.searchsorted(row, np.arange(len(few) + 1)), i, g, np.searchsorted(of, np.arange(len(many))), np.bincount(of, minlength=len(many)), j)


def tfidf_cosine(a, norm_a, b, norm_b, idf):
    """Cosines of TF-IDF vectors of two text columns, made of the texts where they meet; the norms are those of `tfidf_norm`."""
    @F.arrow_udf(DoubleType())
    def run(a: pa.Array, x: pa.Array, b: pa.Array, y: pa.Array) -> pa.Array:
        a, b = a.fill_null("").dictionary_encode(), b.fill_null("").dictionary_encode()
        sides = sorted(((t.dictionary.to_pylist(), t.indices.to_numpy(zero_copy_only=False).astype(np.int64)) for t in (a, b)), key=lambda t: len(t[0]))
        (few, i), (many, j) = sides
        dot = _dots(few, many, i, j, idf.value)
        both = x.fill_null(0).to_numpy(zero_copy_only=False) * y.fill_null(0).to_numpy(zero_copy_only=False)
        return pa.array(np.divide(dot, both, out=np.zeros(len(dot)), where=both > 0))

    return run(a, norm_a, b, norm_b)
