"""Hierarchical packing of documents into sequences of several lengths."""
from __future__ import annotations

import os
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from itertools import count, islice
from string import punctuation

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, as_batch, kept, map_batches, release, slices, table

TIERS = (1024, 512, 256, 128)
STEP = 8
#: Marks that end words, and letters and digits that the tokenizer parts from marks after them.
MARKS, LETTERS = punctuation, frozenset(c for c in map(chr, range(0x250)) if c.isalnum())
#: Distinct words that a worker remembers with their ids, and how many new ones are encoded in one call.
CACHE, TOGETHER = 500_000, 64
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, step_group long"


def spans(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What flat holds from each start on, as much as size says, one after the other."""
    end = np.cumsum(size)
    return flat[np.repeat(start - end + size, size) + np.arange(end[-1] if len(end) else 0)]


class Encoder:
    """Ids of texts by a byte-level BPE tokenizer that cuts before each space; words met before are not encoded again.

    A space before a visible character, and a line break between visible ones,
    always begin a new part of a text, and parts are encoded apart from each
    other. So a text is the parts between spaces, each remembered by its ids.
    Texts with other white space around spaces or breaks are encoded whole. The
    tokenizer also cuts between a letter or digit and marks after it, so a new
    word that ends in marks takes the ids of the word without them, if known.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # each thread of its own would keep memory, and tasks use all cores
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        (self.line,) = self.whole(["\n"])[0]
        self.forget()

    def forget(self) -> None:
        self.index: defaultdict[str, int] = defaultdict(count().__next__)  # numbers words as they are met
        self.flat, self.used = np.zeros(1 << 16, dtype="<u4"), 0
        self.start, self.size, self.kind, self.tail, self.again = (np.zeros(1 << 12, dtype=k) for k in (np.int64, np.int64, np.int8, bool, bool))

    def thin(self) -> None:
        """Remember only the words met again since the last call, none if they are more than half of what may be remembered."""
        at = np.flatnonzero(self.again)
        if len(at) > CACHE // 2:
            return self.forget()
        words, size = list(self.index), self.size[at]  # words stand by their numbers
        self.index = defaultdict(count(len(at)).__next__, ((words[i], k) for k, i in enumerate(at.tolist())))
        ids = spans(self.flat, self.start[at], size)
        self.flat, self.used = np.zeros(max(1 << 16, 2 * len(ids)), dtype="<u4"), len(ids)
        self.flat[:self.used] = ids
        self.start, self.size, self.kind, self.tail, self.again = np.cumsum(size) - size, size, self.kind[at], self.tail[at], np.zeros(len(at), dtype=bool)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def add(self, ids: np.ndarray) -> int:
        """Where these ids now stand."""
        at, self.used = self.used, self.used + len(ids)
        while self.used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[at:self.used] = ids
        return at

    def learn(self, words: list[str], old: int) -> None:
        """Remember words numbered from old on. Kinds: 0 follows a space, 1 follows a line break, 2 is a line break alone, 3 needs its whole text."""
        lines: dict[str, int] = {}  # what is to be encoded, and then its number
        kind, plain, head, marked, marks, rest = [], [], [], [], [], []
        for i, w in enumerate(words):
            broken = w[:1] == "\n"
            own = w[1:] if broken else " " + w
            if not own.isprintable() or not own.strip():  # no other white space is printable
                kind.append((2 if not own else 3 if own[0].isspace() else 1) if broken else 3 if not w or w[0].isspace() else 0)
                rest.append(i)
                continue
            kind.append(1 if broken else 0)
            stem, k = own.rstrip(MARKS), old
            if len(stem) < len(own) and stem[-1:] in LETTERS:
                marked.append(len(plain))
                marks.append(lines.setdefault(own[len(stem):], len(lines)))
                k = self.index.get(w[:len(stem) - len(own)], old)
                own = stem
            plain.append(i)
            head.append(k if k < old else old + lines.setdefault(own, len(lines)))
        own = list(lines)
        groups = self.whole(["\n".join(own[at:at + TOGETHER]) for at in range(0, len(own), TOGETHER)])
        ids = np.array([x for g in groups for x in (self.line, *g)], dtype="<u4")  # now each line begins with the break before it
        at = np.flatnonzero(ids == self.line)
        spaced = np.array([x[0] == " " for x in own], dtype=bool)  # goes without the break
        first, long = self.add(ids) + at + spaced, np.diff(np.append(at, len(ids))) - spaced
        while old + len(words) > len(self.start):
            self.start, self.size, self.kind, self.tail, self.again = (np.concatenate([x, np.zeros(max(len(x), 1 << 12), dtype=x.dtype)]) for x in (self.start, self.size, self.kind, self.tail, self.again))
        head, known, late = np.array(head, dtype=np.int64), np.array(head, dtype=np.int64) < old, slice(old, old + len(words))
        start, size = np.zeros(len(head), dtype=np.int64), np.zeros(len(head), dtype=np.int64)
        start[known], size[known] = self.start[head[known]], self.size[head[known]]
        start[~known], size[~known] = first[head[~known] - old], long[head[~known] - old]
        both = [np.stack(x, axis=1) for x in ((start[marked], first[marks] + 1), (size[marked], long[marks] - 1))] if marked else None
        if both:
            size[marked] = both[1].sum(axis=1)
            start[marked] = self.add(spans(self.flat, both[0].ravel(), both[1].ravel())) + np.cumsum(size[marked]) - size[marked]
        self.start[late][plain], self.size[late][plain], self.kind[late] = start, size, kind
        alone = self.whole([words[i] if kind[i] else " " + words[i] for i in rest])
        size = np.array([len(x) for x in alone], dtype=np.int64)
        self.start[late][rest] = self.add(np.array([y for x in alone for y in x], dtype="<u4")) + np.cumsum(size) - size
        self.size[late][rest], self.tail[late][rest] = size, [words[i][-1:].isspace() for i in rest]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        if len(self.index) > CACHE:
            self.thin()
        old = len(self.index)
        parts = " ".join(["\n" + t.replace("\n", " \n") for t in texts]).split(" ")
        at = np.fromiter(map(self.index.__getitem__, parts), dtype=np.int64, count=len(parts))
        if len(self.index) > old:
            self.learn(list(islice(reversed(self.index), len(self.index) - old))[::-1], old)
        self.again[at[at < old]] = True
        last = np.cumsum([1 + t.count(" ") + t.count("\n") for t in texts]) - 1
        kind, size = self.kind[at], self.size[at]
        odd, alone = kind == 3, np.flatnonzero(kind == 2)
        opens, closes = np.zeros(len(parts), dtype=bool), np.zeros(len(parts), dtype=bool)
        opens[np.append(0, last[:-1] + 1)], closes[last] = True, True
        odd[alone] = closes[alone] | (np.append(kind, 1)[alone + 1] != 1) | ~opens[alone] & ((kind[alone - 1] == 2) | self.tail[at[alone - 1]])
        ids, end = spans(self.flat, self.start[at], size), np.cumsum(size)[last]
        out = [ids[s + 1:e] for s, e in zip([0, *end.tolist()], end.tolist())]  # less the break before each text
        slow = np.unique(np.searchsorted(last, np.flatnonzero(odd))).tolist()
        for n, own in zip(slow, self.whole([texts[n] for n in slow])):
            out[n] = np.array(own, dtype="<u4")
        return out


def pack(lengths: list[int], window: int = TIERS[0], tiers=TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """(tier, pieces) of sequences from remainders shorter than a window; a piece is item, start in item and length.

    An item's tier is the shortest context size that holds it. From the longest
    tier down, its items open windows of that size, longest first. Gaps take the
    longest item that fits, of any tier at or under it; a gap that nothing
    fits, or only badly, takes a cut from the shortest item, whose rest is
    then an item of its own tier. All windows are full but the last of all.
    """
    sizes = sorted({window, *(t for t in tiers if t < window)})
    stock = sorted((n, i, 0) for i, n in enumerate(lengths) if n)
    done: list[tuple[int, list[tuple[int, int, int]]]] = []
    while stock:
        n, i, s = stock.pop()
        tier = sizes[bisect_left(sizes, n)]
        row, room = [(i, s, n)], tier - n
        while room and stock:
            at = bisect_right(stock, (room, 1 << 62, 0)) - 1
            if at < 0 or (room < sizes[0] and stock[at][0] < room):
                n, i, s = stock.pop(0)  # nothing fits well: cut the shortest
                take = min(n, room)
                if n > take:
                    insort(stock, (n - take, i, s + take))
                n = take
            else:
                n, i, s = stock.pop(at)
            row.append((i, s, n))
            room -= n
        done.append((tier, row))
    return done


def steps(tiers: list[int], used: list[int], tokens: int) -> list[int]:
    """A step group for each sequence: one tier each, up to `tokens` tokens of windows, and near-equal tokens in all of a tier."""
    out, at = [0] * len(tiers), 0
    for t in sorted(set(tiers), reverse=True):
        mine = sorted((k for k, x in enumerate(tiers) if x == t), key=lambda k: -used[k])
        groups = -(-len(mine) * t // max(tokens, t))
        for k, x in enumerate(mine):
            out[x] = at + k % groups
        at += groups
    return out


def pack_documents(docs: DataFrame, vocab_path: str, window: int = TIERS[0], group_bytes: int = 8 << 20) -> DataFrame:
    """Pieces of all documents, each id in exactly one.

    Full windows of a document become sequences where it is read; only
    remainders are dealt, by a hash of id and text, into groups of about
    `group_bytes` of text, each packed by one task. Null or empty text is
    the closing id 0 alone. Repeated rows are packed each on its own and null
    ids like others; a very long text is cut into windows and never meets
    others but for its remainder. Other columns are not read. An empty table
    gives no pieces. A step group holds sequences of one tier of a packing
    group, as many tokens as STEP windows at most, and near-equal tokens as
    the others of its tier.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(8, -(-total // group_bytes))
    kinds, pieces = "g long, doc_id long, start long, length long, crc long, n long, ids binary", arrow_schema(PIECES)

    def encode(batches):
        coder, schema = kept(vocab_path, lambda: Encoder(vocab_path)), arrow_schema(kinds)
        for b in slices(batches):
            out = []
            ids = b["doc_id"].to_pylist()
            for i, ids in zip(ids, coder.encode([t or "" for t in b["text"].to_pylist()])):
                raw = ids.tobytes() + bytes(4)
                size = len(raw) // 4
                g = zlib.crc32(raw, zlib.crc32(b"deal%d" % (-1 if i is None else i))) % groups
                full = size // window * window
                for s in range(0, full, window):
                    out.append((g, i, s, window, zlib.crc32(raw[4 * s:4 * (s + window)]), size, None))
                if full < size:
                    out.append((g, i, full, size - full, 0, size, raw[4 * full:]))
            yield as_batch(list(zip(*out)) or [[]] * len(schema), schema)

    def fill(t):
        release()  # the words that encode remembers
        t = t.to_pydict()
        order = sorted(range(len(t["g"])), key=lambda k: (t["doc_id"][k] is None, t["doc_id"][k] or 0, t["start"][k], t["n"][k], t["ids"][k] or b"", t["crc"][k]))
        base = t["g"][0] << 32
        doc, start, n, crc, ids = (t[c] for c in ("doc_id", "start", "n", "crc", "ids"))
        whole, rest = [k for k in order if ids[k] is None], [k for k in order if ids[k] is not None]
        out = [(doc[k], start[k], window, crc[k], n[k], base + at, 0) for at, k in enumerate(whole)]
        used, tiers = [window] * len(whole), [window] * len(whole)
        for tier, row in pack([t["length"][k] for k in rest], window):
            at = 0
            for i, s, size in row:
                k = rest[i]
                out.append((doc[k], start[k] + s, size, zlib.crc32(ids[k][4 * s:4 * (s + size)]), n[k], base + len(used), at))
                at += size
            used.append(at)
            tiers.append(tier)
        step = steps(tiers, used, STEP * window)
        return pa.Table.from_batches([as_batch([*zip(*out), [tiers[r[5] - base] for r in out], [base + step[r[5] - base] for r in out]], pieces)])

    return map_batches(docs.select("doc_id", "text"), encode, kinds).groupBy("g").applyInArrow(fill, PIECES)


def op4_packing(spark, sf_dir) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))
