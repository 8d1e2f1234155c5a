import hashlib
import math
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from html import unescape

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kinweave.llm import chat, common, decontaminate, html, language, licenses, neardup, packing, quality, substrings, urls
from kinweave.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(5000))
ROWS = [(1, "alpha beta gamma delta epsilon zeta " * 12, "en", "a", 1), (2, None, "en", None, None), (3, "", None, "a", 0), (4, LONG, "en", "b", 9), (5, LONG, "en", "b", 9), (5, LONG, "en", "b", 9), (None, "some text", "en", "c", 9)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Null columns, empty and long texts, repeated rows, and columns whose names clash."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.selectExpr("*", "'x' as starts", "1 as class_id", "2 as score", "3 as g", "4 as h", "5 as w")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select * from '{SF}/documents.parquet'").df()


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_every_operator_takes_odd_and_empty_tables(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, None)], "doc_id long, quality int")
    items = spark.createDataFrame([(7, "w1 w2 w3 w4 w5 w6 w7"), (8, None), (None, "w1 w2 w3 w4 w5"), (9, "w1")], "item_id long, text string")
    vocab, bpe = language.public_tokenizers.path("piece_bpe_32k.model"), str(language.public_tokenizers.path("byte_bpe_50k.json"))
    for t, n in ((odd, len(ROWS)), (none, 0)):
        assert quality.score(t, *quality.fit(t, labels)).count() == n
        assert language.predict(t, *language.fit(t, vocab)).count() == n
        assert licenses.scan(t).count() == n
        assert neardup.classes(t).count() == n
        assert substrings.cleaned(t).count() == n
        assert packing.pack_documents(t, bpe).selectExpr("coalesce(sum(length), 0) as n").first().n >= n
        assert {r.doc_id for r in decontaminate.search(t, items).collect()} == ({4, 5} if n else set())
    got = {r.doc_id: r.class_id for r in neardup.classes(odd).collect()}
    assert got[4] == got[5] == 4 and got[2] == 2 and got[3] == 3


def test_pages_and_conversations_take_odd_and_empty_tables(spark):
    schema = "page_id long, url string, html string, text string, host string"
    pages = spark.createDataFrame([(1, None, None, "", ""), (1, "no scheme", "", "", ""), (2, "http://A.example.com/en/7?x#y", "<article><p>a <b>b<p>c &amp; d</article><nav>n</nav>", "", ""), (None, "http://x?/en/", "<p><p", "", "")], schema)
    words = urls.lexicon(language.public_tokenizers.path("word_bpe_49k.json"))
    for t in (pages, pages.limit(0)):
        n = t.count()
        assert urls.classify(urls.with_rules(t), words).count() == n
        assert html.extract(t, html.fit(t)).count() == n
    r = {(x.page_id, x.host): x for x in urls.with_rules(pages).collect()}
    assert r[2, "a.example.com"].rule == "example.com/en/7" and r[None, "x"].path == "" and r[1, ""].rule is None
    log = spark.createDataFrame([(1, 0, 0, "create", "user", "a<|end|>"), (1, 1, 1, "create", "assistant", "x"), (1, 1, 2, "delta", None, "y"), (1, 1, 3, "regenerate", "assistant", "[INST]&lt;"), (1, 1, 4, "delta", "assistant", "z"), (1, 2, 5, "create", "user", "gone"), (1, 2, 6, "delete", None, None), (None, 0, 0, None, None, None)], "conv_id long, msg long, seq long, op string, role string, text string")
    got = {x.conv_id: x.turns for x in chat.read_back(chat.render(chat.fold(log))).collect()}
    assert [tuple(t) for t in got[1]] == [("user", "a<|end|>", False), ("assistant", "[INST]&lt;z", True)]
    assert chat.fold(log.limit(0)).count() == 0


def base_of(text):
    """Base columns of op1, the slow way."""
    words = re.split(r"[\x20\x09-\x0D]+", text or "")
    words = [w for w in words if w]
    lines = (text or "").split("\n")
    dup = sum(1 for i, x in enumerate(lines) if x.strip("\x20\t\n\x0b\x0c\r") and x in lines[:i])
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    inside = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside)


def test_quality_counts_as_brute_force():
    text = "a b c a b c d\nx y\nx y\n\n#$ <|>"
    assert quality.base_counts(text) == base_of(text) == (13, 16, 5, 1, 6)


def test_quality_as_brute_force(spark, docs):
    labels = duckdb.sql(f"select doc_id, max(quality) as q from '{SF}/labels.parquet' where doc_id is not null group by doc_id").df()
    of = dict(zip(labels.doc_id, labels.q))
    counts = {i: Counter(quality.buckets_of(re.findall(r"[^\x20\x09-\x0D]+", t or "")).tolist()) for i, t in zip(docs.doc_id, docs.text)}
    base = {i: base_of(t) for i, t in zip(docs.doc_id, docs.text)}
    failed = {i: v[0] < 50 or 100 * v[4] > 50 * v[0] for i, v in base.items()}
    raw, good = Counter(), Counter()
    for i, c in counts.items():
        raw.update(c)
        good.update(c if of.get(i) == 1 else {})
    n, size = (sum(raw.values()), sum(good.values())), quality.BUCKETS

    def mean(c, less_raw=None, less_good=None):
        a, b = less_raw or Counter(), less_good or Counter()
        na, nb = n[0] - sum(a.values()), n[1] - sum(b.values())
        return sum(v * (math.log((good[x] - b[x] + 0.5) / (nb + 0.5 * size)) - math.log((raw[x] - a[x] + 0.5) / (na + 0.5 * size))) for x, v in c.items()) / sum(c.values()) if c else 0.0

    left = {q: [mean(counts[i], counts[i], counts[i] if q else None) for i in counts if of.get(i) == q and counts[i] and not failed[i]] for q in (0, 1)}
    low, high = (sum(v) / len(v) for v in (left[0], left[1]))
    spread = (sum(v * v for v in left[1]) / len(left[1]) - high * high) ** 0.5
    threshold = min(max((low + high) / 2, high - 6 * spread), high)
    for r in QUERIES["op1_quality"](spark, SF).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base[r.doc_id] and r.base_failed == failed[r.doc_id]
        assert r.llr == pytest.approx(mean(counts[r.doc_id])) and r.kept == (not failed[r.doc_id] and r.llr >= threshold)


def test_language_as_brute_force(spark, docs):
    vocab = language.public_tokenizers.path("piece_bpe_32k.model")
    langs, model = language.fit(spark.createDataFrame(docs[["doc_id", "lang", "text"]]), vocab)
    some = docs.sample(12, random_state=1)

    @lru_cache(None)
    def logs(word):
        total = []
        for k in range(len(langs)):
            a, log = [1.0] + [0.0] * len(word), 0.0
            for j in range(1, len(word) + 1):
                a[j] = sum(a[i] * model[word[i:j]][k] for i in range(j) if word[i:j] in model) or a[j - 1] * language.UNKNOWN
            total.append(math.log(a[-1]))
        return total

    got = {r.doc_id: r for r in language.predict(spark.createDataFrame(some[["doc_id", "text"]]), langs, model).collect()}
    for i, text in zip(some.doc_id, some.text):
        sums = np.sum([logs("▁" + w) for w in re.findall(r"[^\W\d_]+", text.lower())], axis=0)
        assert got[i].lang_pred == langs[int(np.argmax(sums))] and got[i].score == pytest.approx(1 / np.exp(np.maximum(sums - sums.max(), -700)).sum())


def test_odd_rows_of_row_by_row_operators(spark):
    big = 2**53 + 1
    rows = [(4, "alpha beta " * 30), (5, "½ ²"), (None, "some text here"), (big, None), (big, ""), (6, "the house and the garden"), (6, "the house and the garden"), (7, LONG)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as lang_pred", "1 as score", "2 as n_words", "3 as labels").coalesce(1)
    want = Counter(i for i, _ in rows)
    vocab = language.vocabulary(language.public_tokenizers.path("piece_bpe_32k.model"))
    model = {p: (0.5 if p.startswith("▁") else 0.1, 0.2) for p in vocab}
    got = language.predict(df, ["aa", "bb"], model).select("*", language.held_out(F.col("doc_id")).alias("held")).collect()
    assert Counter(r.doc_id for r in got) == want and [(r.lang_pred, r.score) for r in got if r.doc_id in (5, big)] == [("und", 0.0)] * 3
    assert {r.doc_id: r.held for r in got} == {i: i is None or zlib.crc32(str(i).encode()) % 5 == 0 for i in want} and all(0 <= r.score <= 1 for r in got)
    everything = language.predict(df, ["aa", "bb"], model, keep=df.columns, out=("__l", "__s"))
    assert everything.columns == [*df.columns, "__l", "__s"] and {r.lang_pred for r in everything.collect()} == {"x"}
    scored = quality.score(df, np.zeros(quality.BUCKETS), 0.0).collect()
    assert Counter(r.doc_id for r in scored) == want and [(r.n_words, r.base_failed, r.kept) for r in scored if r.doc_id == big] == [(0, True, False)] * 2
    assert [(r.n_words, r.kept) for r in scored if r.doc_id == 7] == [(5000, True)]
    found = licenses.scan(df).collect()
    assert Counter(r.doc_id for r in found) == want and [(r.n_words, r.first_word, r.labels, r.score) for r in found if r.doc_id == big] == [(0, None, "", 0.0)] * 2
    packed = packing.pack_documents(df, str(packing.public_tokenizers.path("byte_bpe_50k.json"))).collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == want and [(r.length, r.doc_tokens) for r in packed if r.doc_id == big] == [(1, 1)] * 2
    assert sum(r.length for r in packed if r.doc_id == 7) == {r.doc_tokens for r in packed if r.doc_id == 7}.pop()
    pages = spark.createDataFrame([(big, "http://a.example.com/en/9", "<p>foo<wbr>bar</p>"), (None, None, None), (3, "no scheme", "")], "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as text").coalesce(1)
    judged = urls.classify(urls.with_rules(pages), {"en": -1.0}).collect()
    assert {(r.page_id, r.host, r.rule, r.verdict) for r in judged} == {(big, "a.example.com", "com/en/", "block"), (None, "", None, "allow"), (3, "", None, "allow")}
    assert {(r.page_id, r.text) for r in html.extract(pages, None).collect()} == {(big, "foobar"), (None, ""), (3, "")}


def test_language_on_held_out_rows(spark, docs):
    got = QUERIES["op2_language"](spark, SF).toPandas().merge(docs, on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    test = got[got.held_out & got.lang.notna() & got.text.notna()]
    assert (test.lang_pred == test.lang).mean() > 0.95


def every_segmentation(word, prob):
    """Sum over all segmentations, by recursion; an unknown character stands alone."""
    if not word:
        return 1.0
    ends = [j for j in range(1, len(word) + 1) if word[:j] in prob]
    return sum(prob[word[:j]] * every_segmentation(word[j:], prob) for j in ends) if ends else None


def test_forward_sums_all_segmentations():
    rng = random.Random(1)
    pieces = {"".join(rng.choice("abc") for _ in range(n)) for n in (1, 1, 1, 2, 2, 3, 4, 5) * 3} | {"a", "b", "c"}
    model = {p: (rng.random() / 10, rng.random() / 100) for p in pieces}
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) for _ in range(200)] + ["ab"]
    short = [w for w in words if len(w) <= 12]
    s = language.Scorer(model, 2)
    got = dict(zip(words, s.forward(words)))
    for w in short:
        for k in (0, 1):
            assert got[w][k] == pytest.approx(math.log(every_segmentation(w, {p: v[k] for p, v in model.items()})))
    alone = {w: s.forward([w])[0] for w in words}  # others in the batch change nothing
    assert all(np.allclose(got[w], alone[w]) for w in words)
    row = {w: s.forward(["▁" + w])[0] for w in words}
    assert np.allclose(s.totals([words, [], words[:2]]), [sum(row[w] for w in words), [0, 0], row[words[0]] + row[words[1]]])
    assert s.forward(["aüb"])[0][0] == pytest.approx(math.log(model["a"][0] * language.UNKNOWN * model["b"][0]))
    assert np.isfinite(s.forward(["ab" * 4000 + "ü" * 3000])).all()


def test_words_are_letter_runs():
    assert language.words_of("½ ² 12 _x_ Ünï-cödé Ⅷ a²b") == ["x", "ünï", "cödé", "a", "b"] and language.words_of(None) == [] and language.words_of("½ ²") == []


def test_encoder_gives_the_tokenizer_s_ids():
    rng = random.Random(3)
    parts = [" ", "\n", "\t", "a", "bc", "'s", "12", ".", "é", "　", "\x1c", "\x85", "<|endoftext|>", "\r", "日本", " x"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + ["", "a" * 5000, LONG]
    e = packing.Encoder(str(packing.public_tokenizers.path("byte_bpe_50k.json")))
    got = [x.tolist() for i in range(0, len(texts), 100) for x in e.encode(texts[i:i + 100])]
    assert got == e.whole(texts)


def test_encoder_forgets_words_met_once(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 400)
    rng = random.Random(4)
    usual = ["tal", "der", "12", "é", "x\ny", "日本"]
    texts = [" ".join([*usual, *(f"w{rng.random()}" for _ in range(9)), *usual[::-1]]) for _ in range(300)]
    e, most = packing.Encoder(str(packing.public_tokenizers.path("byte_bpe_50k.json"))), 0
    for i in range(0, len(texts), 10):
        assert [x.tolist() for x in e.encode(texts[i:i + 10])] == e.whole(texts[i:i + 10])
        most = max(most, len(e.index))
    assert most <= 400 + 110
    e.thin()
    assert {"der", "12", "é", "日本"} <= set(e.index) and len(e.index) < 20


def test_encoder_takes_known_words_before_marks(monkeypatch):
    e, asked = packing.Encoder(str(packing.public_tokenizers.path("byte_bpe_50k.json"))), []
    ids = e.whole
    e.encode(["x anble tion\nshing"])
    monkeypatch.setattr(e, "whole", lambda texts: asked.extend(texts) or ids(texts))
    texts = ["x anble, tion. anble?!\nshing,\nshing. tion", "x anble. tion,\nshing?!"]
    got = [x.tolist() for x in e.encode(texts)]
    assert set("\n".join(asked).split("\n")) == {",", ".", "?!"}  # no word again
    assert got == ids(texts)


def test_encoder_cuts_marks_off_where_the_tokenizer_does():
    assert all(c == " " or not c.isprintable() for c in map(chr, range(0x110000)) if c.isspace())
    e, rng = packing.Encoder(str(packing.public_tokenizers.path("byte_bpe_50k.json"))), random.Random(5)
    ends = [*packing.MARKS, "###", "'", "'.", "...", "<|endoftext|>"]
    texts = [f"x{c}{m} {c}{m}\n{c}{m}\n\nx{c}{m}" for c in sorted(packing.LETTERS) for m in ends]
    parts = ["a", "é", "9", "²", "½", "ª", "µ", "×", "一", "à", "e\u0301", "°", "_", "'s", "n't", ".", ",", "'", "’", "\u200b", " ", " ", "\n", "\t"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    rng.shuffle(texts)
    for i in range(0, len(texts), 300):
        assert [x.tolist() for x in e.encode(texts[i:i + 300])] == e.whole(texts[i:i + 300])
    assert e.encode([]) == []


def test_packing_frees_words_before_it_fills(spark):
    path = str(packing.public_tokenizers.path("byte_bpe_50k.json"))
    packing.pack_documents(spark.createDataFrame([(k, f"a b {k}") for k in range(200)], "doc_id long, text string").repartition(8), path).count()

    def held(_):
        from kinweave.llm import common

        yield path in common._KEPT

    assert not all(spark.sparkContext.parallelize(range(8), 8).mapPartitions(held).collect())


def test_workers_get_long_texts_in_small_batches(spark):
    long = spark.range(0, 300, 1, 1).selectExpr("id as doc_id", "repeat('long text ', 20000) as text")
    held = common.per_batch(long, lambda b: [[b["text"].buffers()[2].size]], "n long").collect()  # of the whole batch
    assert 0 < max(r.n for r in held) <= 2 * common.BATCH_BYTES
    ids = packing.pack_documents(long, str(packing.public_tokenizers.path("byte_bpe_50k.json"))).selectExpr("sum(length) as n", "count(distinct doc_id) as k").first()
    assert ids.n % 300 == 0 and ids.n > 300 * 40000 and ids.k == 300


def test_encoder_starts_no_threads():
    own = """if True:
        import os
        from kinweave.llm import packing
        old = len(os.listdir("/proc/self/task"))
        e = packing.Encoder(str(packing.public_tokenizers.path("byte_bpe_50k.json")))
        e.encode([" ".join(f"w{i}" for i in range(9000))] * 3 + ["\\tx"] * 50)
        print(len(os.listdir("/proc/self/task")) - old)"""
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    assert subprocess.run([sys.executable, "-c", own], env=env, capture_output=True, text=True, check=True).stdout == "0\n"


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    bpe = language.public_tokenizers.path("byte_bpe_50k.json")
    got = QUERIES["op4_packing"](spark, SF).toPandas()
    tok = Tokenizer.from_file(str(bpe))
    for d, text in zip(docs.doc_id, docs.text):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in got[got.doc_id == d].sort_values("start").itertuples():
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 1024


def test_license_places():
    got = licenses.scan_text("The MIT License, and GNU General Public License version 3; cc by. cc-by")
    assert got[:4] == (14, 4, 1, 12) and got[4] == "cc-by,gpl,mit" and "gpl-3" in got[5] and len(licenses.rules()) > 200


def test_license_base_as_brute_force(spark, docs):
    for r in QUERIES["op5_licenses"](spark, SF).collect():
        text = docs.text[docs.doc_id == r.doc_id].iloc[0] or ""
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))
        places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
        base = sorted({x for _, x in places})
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None, ",".join(base))
        assert set(base) <= set(r.labels.split(",")) | {""} and r.labels == ",".join(sorted(set(r.labels.split(",")))) and 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_licenses_by_priority_and_keyword():
    of = lambda t: licenses.scan_text(t)[5]
    assert of("Licensed under the Apache License, Version 2.0 (the License)") == "apache,apache-2.0"
    assert of("SPDX-License-Identifier: MIT") == "mit" and of("GPLv3") == "gpl-3" and of("emitted licenses of bsdx") == ""
    assert of("Redistribution and use in source and binary forms, with or without modification") == "bsd"
    assert of("The Software shall be used for Good, not Evil.") == "json" and of("Creative Commons Attribution-ShareAlike") == "cc-by-sa"
    spans = licenses.detect(t := "gnu general public license version 3 or later", set(t.split()))
    assert [x[2] for x in spans] == ["gpl-3-or-later"]  # version 3, and the name alone, lie inside
    for label, _, key, rx in licenses.rules():
        assert re.search(rf"(?<![a-z0-9]){key}(?![a-z0-9])", rx.pattern), (label, key)


def test_chat_same_as_sql(spark):
    db = duckdb.connect()
    db.sql(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want, got = db.sql(ORACLES["op6_chat"]).df(), QUERIES["op6_chat"](spark, SF).toPandas()
    pd.testing.assert_frame_equal(got.sort_values("conv_id", ignore_index=True)[want.columns], want.sort_values("conv_id", ignore_index=True), check_dtype=False)


def test_random_logs_fold_as_brute_force(spark):
    rng = random.Random(11)
    rows, want = [], {}
    for conv in range(40):
        turns = []
        for msg in range(rng.randint(1, 4)):
            log, text, gone = [("create", "a")], "a", False
            for _ in range(rng.randint(0, 6)):
                op = rng.choice(["delta", "delta", "edit", "regenerate"])
                part = rng.choice(["<|end|>", "[x", "&lt;", "", "é"])
                log.append((op, part))
                text = text + part if op == "delta" else part
            if rng.random() < 0.2:
                log.append(("delete", None))
                gone = True
            rows += [(conv, msg, k, op, "assistant" if msg % 2 else "user", t) for k, (op, t) in enumerate(log)]
            turns += [] if gone else [("assistant" if msg % 2 else "user", text, bool(msg % 2))]
        want[conv] = turns
    rng.shuffle(rows)
    log = spark.createDataFrame(rows, "conv_id long, msg long, seq long, op string, role string, text string")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.read_back(chat.render(chat.fold(log))).collect()}
    assert got == want


def test_decontamination_as_brute_force(spark, docs):
    items = duckdb.sql(f"select * from '{SF}/benchmark.parquet'").df()
    d = {i: shingles(t) for i, t in zip(docs.doc_id, docs.text)}
    b = {i: shingles(t) for i, t in zip(items.item_id, items.text)}
    want = {(x, y) for x, s in d.items() for y, t in b.items() if t and len(s & t) >= 0.8 * len(t)}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op7_decontaminate"](spark, SF).collect()} == want


def edits(a, b):
    """Edit distance of lists, the whole table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def near(a, b):
    """Word edit similarity of at least 0.8, by the whole table where the words in common allow it."""
    n = max(len(a), len(b))
    return n - sum((Counter(a) & Counter(b)).values()) <= 0.2 * n + 1e-9 and edits(a, b) <= 0.2 * n + 1e-9


def test_banded_distance_as_the_whole_table():
    rng = random.Random(7)
    for _ in range(3000):
        a = [rng.randrange(4) for _ in range(rng.randint(0, 14))]
        b = [x for x in a if rng.random() > 0.1] if rng.random() < 0.5 else [rng.randrange(4) for _ in range(rng.randint(0, 14))]
        if b and rng.random() < 0.5:
            b[rng.randrange(len(b))] = 9
        most, want = rng.randint(0, 8), edits(a, b)
        for f in (neardup.banded, neardup.distance_within):
            assert f(np.array(a, dtype=int), np.array(b, dtype=int), most) == (want if want <= most else None)
    a = np.arange(3000)
    b = np.delete(np.where(a % 7 == 0, -1, a), [5, 900, 2000])
    assert neardup.distance_within(a, b, 600) == 432 and neardup.distance_within(a, b, 431) is None and neardup.distance_within(a, a[::-1], 600) is None


def test_near_copies_as_brute_force(spark, docs):
    words = {i: re.findall(r"[^\W_]+", t.lower()) for i, t in zip(docs.doc_id, docs.text) if t}
    words = {i: w for i, w in words.items() if w}
    cls = closed(sorted(words), lambda a, b: near(words[a], words[b]))
    got = {r.doc_id: r.class_id for r in QUERIES["op8_neardup"](spark, SF).collect()}
    assert got == {i: cls.get(i, i) for i in docs.doc_id}


def test_near_copies_of_odd_rows(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(50)) for c in "pq")
    big = 2**53 + 1
    rows = [(1, one), (1, two), (7, two), (8, one), (8, one), (None, one), (None, None), (3, None), (4, ""), (4, ""), (big, "x y z"), (big + 1, "x y z"), (9, "½ -- !")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'a' as class_id", "'b' as k1", "'c' as h1").coalesce(1)
    got = neardup.classes(df).collect()
    key = {(r, t): {x.class_key for x in got if x.doc_id == r} for r, t in rows}
    assert len(got) == len(rows)
    assert len(key[7, two]) == len(key[8, one]) == 1 and key[7, two] != key[8, one] and key[1, one] == key[7, two] | key[8, one]
    assert {x.class_id for x in got if x.doc_id == 8} == {x.class_id for x in got if x.doc_id == 7} == {1}
    assert [(x.class_id, x.class_key) for x in got if x.doc_id in (3, 4)] == [(3, None), (4, None), (4, None)]
    assert {x.class_id for x in got if x.doc_id in (big, big + 1)} == {big} and key[9, "½ -- !"] != {None}
    assert sorted(x.class_id or 0 for x in got if x.doc_id is None) == [0, 1]
    stay = neardup.one_of_each(df).collect()
    assert sorted(((r.doc_id or 0, r.text or "") for r in stay)) == sorted([(1, one), (1, two), (0, ""), (3, ""), (4, ""), (big, "x y z"), (9, "½ -- !")])
    assert neardup.one_of_each(df).columns == df.columns and neardup.one_of_each(df.limit(0)).count() == 0


def test_a_representative_stays_though_its_id_has_another_text(spark):
    a, b = ([f"{c}{i}" for i in range(50)] for c in "ab")
    rows = [(3, " ".join(a)), (5, " ".join([*a[:49], "x"])), (3, " ".join(b)), (2, " ".join([*b[:49], "x"]))]
    stay = neardup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in stay) == sorted([rows[0], rows[3]])


def article_of(page):
    """Text of the article element by regular expressions, blocks apart."""
    inner = re.search(r"(?s)<article[^>]*>(.*?)</article>", page)
    inner = re.sub(r"(?s)<!--.*?-->|<(script|style|form|aside|nav|footer|button|figure)\b.*?</\1>", "", inner.group(1)) if inner else ""
    inner = re.sub(r"(?i)<(/?)(b|i|em|strong|a|span|code|wbr|sup|sub|img)\b[^>]*>", "", inner)
    inner = re.sub(r"(?i)<br[^>]*>", " ", inner)
    blocks = [" ".join(unescape(x).split()) for x in re.split(r"<[^>]+>", inner)]
    return "\n\n".join(x for x in blocks if x)


def test_html_articles(spark):
    got = QUERIES["op9_html"](spark, SF).toPandas()
    pages = duckdb.sql(f"select * from '{SF}/pages.parquet'").df().set_index("page_id").html
    for r in got.itertuples():
        assert "track(" not in r.text and "&copy;" not in r.text and r.n_chars == len(r.text)
        h1 = re.search(r"<article><h1>([^<&]*)</h1>", pages[r.page_id])
        assert not h1 or r.text.startswith(" ".join(h1.group(1).split()))
    same = [r.text == article_of(pages[r.page_id]) for r in got.itertuples()]
    assert np.mean(same) > 0.95


def test_urls_as_brute_force(spark):
    pages = duckdb.sql(f"select page_id, url from '{SF}/pages.parquet'").df()
    words = urls.lexicon(language.public_tokenizers.path("word_bpe_49k.json"))
    rules = [(h, p, v) for v, h, p in urls.RULES]
    t = urls.Tokens(words, urls.rule_tokens(words))
    rows = []
    for i, url in zip(pages.page_id, pages.url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rows.append((i, host, path, *(max(fits)[1:] if fits else (None, None)), [zlib.crc32(x.encode()) % urls.BUCKETS for x in t.of(host, path)]))
    seen = {v: Counter(c for r in rows if r[4] == v for c in r[5]) for v in ("allow", "block")}
    size = {v: sum(c.values()) + 0.1 * urls.BUCKETS for v, c in seen.items()}
    got = {r.page_id: r for r in QUERIES["op3_urls"](spark, SF).collect()}
    for i, host, path, rule, verdict, cells in rows:
        odds = sum(math.log((seen["block"][c] + 0.1) / size["block"]) - math.log((seen["allow"][c] + 0.1) / size["allow"]) for c in cells)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule) and got[i].score == pytest.approx(odds, abs=1e-9)
        assert got[i].verdict == (verdict or ("block" if odds > 1e-12 else "allow"))


def test_names_are_segmented():
    words = {"news": -3.0, "paper": -3.0, "newspaper": -5.0, "new": -3.0, "spa": -4.0, "per": -4.0, "häuser": -3.0}
    assert urls.segment("newspaperx", words, 9) == ["newspaper", "x"] and urls.segment("newshäuser", words, 9) == ["news", "häuser"]
    assert "".join(urls.segment("abcnewsq", words, 9)) == "abcnewsq" and urls.segment("", words, 9) == []


def test_repeats_as_brute_force(spark, docs):
    seen, got = set(), {r.doc_id: r for r in QUERIES["op10_substrings"](spark, SF).collect()}
    for d, text in sorted(zip(docs.doc_id, docs.text)):
        w, gone = re.findall(r"[^\x20\x09-\x0D]+", text or ""), set()
        for i in range(len(w) - 19):
            k = tuple(w[i:i + 20])
            if k in seen:
                gone.update(range(i, i + 20))
            seen.add(k)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert (got[d].n_words, got[d].n_removed, got[d].kept_sha256) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and [s[0] for s in corpus_pipeline.STAGES] == ["language", "neardup", "substrings", "decontaminate", "packing"]


def test_pipeline_stages_on_odd_rows(spark):
    """Each stage by itself: null and repeated ids, null, empty and long texts, repeated rows, clashing names, no rows."""
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choice(["house", "garden", "water", "green", "winter", "river", "stone", "letter"]) + rng.choice(["", "s", "ing", "ed"]) + str(rng.choice("abcdefgh")) * rng.randint(0, 2) for _ in range(n))
    one, two, three, long = prose(60), prose(60), prose(60), prose(3000)
    big, item = 2**53 + 1, "what is the capital of the largest country"
    rows = [(1, one), (1, one), (1, two), (7, two), (None, one), (None, None), (3, None), (4, ""), (5, "½ ² 12"), (big, three), (big, long), (9, f"{three} {item} more")]
    extra = ["'en' as lang", "'a' as source", "0L as n_chars", "1 as __lang_pred0", "2 as h1", "3 as p", "4 as class_id", "5 as g"]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *extra).coalesce(1)
    got = lambda stage, d=df: Counter((r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)[stage](spark, d, SF).collect())
    has_letters = Counter({k: n for k, n in Counter(rows).items() if k[1] and any(c.isalpha() for c in k[1])})
    learn = [(1000 + i, prose(30)) for i in range(40)]  # odd rows alone may all be held out
    more = df.unionByName(spark.createDataFrame(learn, "doc_id long, text string").selectExpr("*", *extra))
    assert got("language", more) == has_letters + Counter(learn)
    assert got("neardup") == Counter([(1, one), (1, two), (None, None), (3, None), (4, ""), (5, "½ ² 12"), (big, long), (9, f"{three} {item} more")])  # 9 is near the first text of big
    cut = got("substrings")
    assert cut[1, one] == 2 and cut[1, two] == 1 and cut[7, ""] == 1 and cut[None, ""] == 1 and cut[None, None] == cut[3, None] == cut[4, ""] == 1 and cut[big, long] == 1 and sum(cut.values()) == len(rows)
    assert (big, "") in cut and any(i == 9 and t.endswith("more") and len(t.split()) >= 60 for i, t in cut)
    items = spark.createDataFrame([(1, item), (2, None)], "item_id long, text string")
    left = Counter((r.doc_id, r.text) for r in decontaminate.without(df.union(df.where("doc_id = 9").selectExpr("null", "text", *[f"`{c}`" for c in df.columns[2:]])), items).collect())
    assert left == Counter(r for r in rows if r[0] != 9)
    pieces = corpus_pipeline.packed(spark, df, SF).collect()
    assert Counter(r.doc_id for r in pieces if r.start == 0) == Counter(i for i, _ in rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, SF).columns == df.columns and stage(spark, df.limit(0), SF).count() == 0, name
    assert corpus_pipeline.packed(spark, df.limit(0), SF).count() == 0


def closed(ids, like):
    """Class by id: the smallest id that pairs for which `like` holds lead to."""
    cls = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if a < b and cls[a] != cls[b] and like(a, b):
                old, new = max(cls[a], cls[b]), min(cls[a], cls[b])
                cls = {i: new if c == old else c for i, c in cls.items()}
    return cls


def test_near_copies_linked_through_a_text_like_a_leader_in_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 100)
    base = [f"b{i}" for i in range(60)]
    texts = [base]
    for g in range(150):  # each A is like the base, its B like A only
        a = [f"x{g}.{i}" if i in range(g % 20, g % 20 + 9) else w for i, w in enumerate(base)]
        texts += [a, [f"y{g}.{i}" if i in range(30 + g % 20, 39 + g % 20) else w for i, w in enumerate(a)]]
    texts = [[w.replace(".", "z") for w in t] for t in texts]
    like = lambda a, b: near(texts[a], texts[b])
    assert like(0, 1) and like(1, 2) and not like(0, 2)
    monkeypatch.setattr(neardup, "order_minhash", lambda h: [1])  # one bucket holds all: no other can help
    got = {r.doc_id: r.class_id for r in neardup.classes(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).collect()}
    assert got == closed(range(len(texts)), like)


def test_quality_counts_every_labelled_document(spark):
    n = 20_600  # more than were once counted
    texts = [f"w{i % 997} v{i} " + "a b " * (i % 3) for i in range(n)]
    docs = spark.createDataFrame([*enumerate(texts), (None, "no id")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 50 and 1) for i in range(n - 100)], "doc_id long, quality int")
    count = lambda some: np.bincount(np.concatenate([quality.buckets_of(t.split()) for t in some]), minlength=quality.BUCKETS)
    raw, good = count([*texts, "no id"]), count(t for i, t in enumerate(texts[:n - 100]) if i % 50)
    want = np.log((good + 0.5) / (good.sum() + 0.5 * quality.BUCKETS)) - np.log((raw + 0.5) / (raw.sum() + 0.5 * quality.BUCKETS))
    assert np.allclose(quality.fit(docs, labels)[0], want)


def test_packed_counts_come_back():
    for at, own in (([0], [1]), ([3, 70_000], [1, 300]), (list(range(5, 900, 4)), [70_000] * 224)):
        got = quality.unpacked(quality.packed_counts(np.array(at), np.array(own)))
        assert [x.tolist() for x in got] == [at, own]


def test_packing_routes_fills_and_balances():
    short = packing.pack([100, 90, 128, 60, 250, 33] * 40)
    assert {t for t, _ in short} == {256, 128}  # no item is longer than 256
    mixed = packing.pack([900, 700, 400, 300, 200, 100, 50, 20] * 30)
    assert {t for t, _ in mixed} >= {1024, 512}
    for got, lengths in ((short, [100, 90, 128, 60, 250, 33] * 40), (mixed, [900, 700, 400, 300, 200, 100, 50, 20] * 30)):
        assert all(sum(n for *_, n in row) == t for t, row in got[:-1])
        pieces = sorted(p for _, row in got for p in row)
        for i, n in enumerate(lengths):
            mine = [(s, m) for j, s, m in pieces if j == i]
            assert [s for s, _ in mine] == [sum(m for _, m in mine[:k]) for k in range(len(mine))] and sum(m for _, m in mine) == n
        for t, row in got:  # an item of the tier opens each window
            assert t == min(x for x in packing.TIERS if x >= row[0][2])
    tiers = [1024] * 9 + [256] * 33 + [128]
    used = [1024] * 9 + [256] * 33 + [7]
    of = packing.steps(tiers, used, 8 * 1024)
    tokens = defaultdict(lambda: defaultdict(int))
    for t, u, g in zip(tiers, used, of):
        tokens[t][g] += u
    assert sum(map(len, tokens.values())) == len(set(of))  # one tier each
    assert sorted(tokens[1024].values()) == [4096, 5120] and sorted(tokens[256].values()) == [16 * 256, 17 * 256]


def test_packing_of_short_documents_uses_short_windows(spark):
    docs = spark.createDataFrame([(i, "one two three " * (i % 9 + 1)) for i in range(400)], "doc_id long, text string")
    got = packing.pack_documents(docs, str(packing.public_tokenizers.path("byte_bpe_50k.json"))).toPandas()
    used = got.groupby("sequence_id").agg(n=("length", "sum"), tier=("tier", "first"), g=("step_group", "first"))
    assert set(used.tier) == {128} and (used.n < 128).sum() <= 8
    assert got.groupby("step_group").tier.nunique().max() == 1


def test_expected_counts_on_long_runs():
    prob = {"▁": 0.1, "a": 0.2, "b": 0.3, "ab": 0.1}
    for word, want in (("▁" + "ab" * 400, None), ("▁a" + "x" * 100 + "b", {"▁": 1, "a": 1, "b": 1})):
        got = language.expected(word, prob, 12)
        if want is None:  # each pair is one piece or two, with odds of 0.1 to 0.06
            want = {"▁": 1, "ab": 400 * 0.1 / 0.16, "a": 400 * 0.06 / 0.16, "b": 400 * 0.06 / 0.16}
        assert got == pytest.approx(want)


def test_rare_languages_are_learned(spark):
    rows = [(i, "en", "the house and the garden") for i in range(400)] + [(1000 + i, "zz", "das haus und der garten") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    vocab = language.public_tokenizers.path("piece_bpe_32k.model")
    assert language.fit(df, vocab, max_rows=3)[0] == ["en", "zz"]


def test_near_copies_do_not_join_moved_halves(spark):
    w = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(w)), (2, " ".join(w[150:] + w[:150])), (3, " ".join([*w[:299], "x"]))]
    assert len(shingles(rows[0][1]) & shingles(rows[1][1])) >= 0.8 * len(shingles(rows[0][1]) | shingles(rows[1][1]))
    got = {r.doc_id: r.class_id for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
