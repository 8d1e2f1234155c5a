import glob
import math
import os
import random
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kinweave.functions import similarity as sim
from kinweave.functions.normalize import preprocess
from kinweave.operators import blocking, errors, evaluate, features, models, records, splits, submission
from kinweave.operators.records import ID1, ID2
from kinweave.plans import cli, experiments, report_queries  # noqa: F401
from kinweave.plans.link import link, prepared, run_pipeline
from kinweave.plans.queries import SQL, Q, raw_records
from kinweave.sources import tsv
from kinweave.sources.tsv import read_tsv, write_tsv
from kinweave.streaming.normalize import exact_matches

SF = "/root/testdata/sf0.001"
PAIR = f"{ID1} string, {ID2} string"


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple("" if x is None or x != x else str(x) for x in r) for r in df[cols].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    db = duckdb.connect()
    for p in glob.glob(SF + "/*.parquet"):
        db.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    want, got = db.sql(SQL[name]).df(), Q[name](spark, SF).toPandas()
    for c in got.columns:
        if got[c].dtype == float or want[c].dtype == float:
            got[c], want[c] = got[c].astype(float).round(6), want[c].astype(float).round(6)
    assert rows(got) == rows(want)


# ---- text


def test_normalisation_keeps_points_that_a_comma_hides(spark):
    df = spark.createDataFrame([("S1-1", "Straße & Co. Ltd", "12 MG Rd., Bangalore", "")], "entity_id string, business_name string, business_address string, country string")
    r = preprocess(df).first()
    assert (r.name_norm, r.address_norm, r.source) == ("strasse and company limited", "12 mg rd bangalore", "S1")
    assert r.address_tokens == ["12", "mg", "rd", "bangalore"]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def slow_ratio(a, b):
    return float(a == b) if not a or not b else 2 * lcs(a, b) / (len(a) + len(b))


def slow_partial(a, b):
    if not a or not b:
        return float(a == b)

    def best(s, t):
        return max(slow_ratio(s, t[max(0, i):i + len(s)]) for i in range(1 - len(s), len(t)))

    return max(best(a, b), best(b, a)) if len(a) == len(b) else best(*sorted((a, b), key=len))


def slow_sets(a, b):
    if not a or not b:
        return float(a == b)
    x, y = set(a.split()), set(b.split())
    both, p, q = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and not (p and q):
        return 1.0
    u, v = f"{both} {p}".strip(), f"{both} {q}".strip()
    return max([slow_ratio(u, v)] + ([slow_ratio(both, u), slow_ratio(both, v)] if both else []))


def test_ratios_as_brute_force():
    rng = random.Random(1)
    make = lambda: " ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 4))) for _ in range(rng.choice([0, 1, 3, 8, 20, 45]))).strip()
    a, b = [make() for _ in range(150)], [make() for _ in range(150)]
    b[:5] = a[:5]
    assert np.allclose(sim.indel(a, b), [slow_ratio(x, y) for x, y in zip(a, b)])
    assert np.allclose(sim.partial(a, b), [slow_partial(x, y) for x, y in zip(a, b)])
    assert np.allclose(sim.token_sets(a, b), [slow_sets(x, y) for x, y in zip(a, b)])
    assert np.allclose(sim.sorted_tokens(a, b), [slow_ratio(" ".join(sorted(x.split())), " ".join(sorted(y.split()))) for x, y in zip(a, b)])


def test_ratios_of_known_texts():
    one = lambda f, a, b: float(f([a], [b])[0])
    assert one(sim.indel, "ab", "cd") == 0 and one(sim.indel, "", "") == 1 and one(sim.indel, "", "a") == 0
    assert one(sim.token_sets, "a b", "b a c") == 1 and one(sim.sorted_tokens, "b a", "a b") == 1 and one(sim.partial, "bc", "abcd") == 1
    assert one(sim.indel, "a" * 70, "a" * 130) == 0.7 and one(sim.token_sets, "x y", "z") == one(sim.indel, "x y", "z")


def test_lists_of_ids_and_json(spark):
    df = spark.createDataFrame([(" S2-1, ,S2-1,S3-2 ",), ("",), (None,), (" , ",)], "t string")
    got = df.select(tsv.split_ids(df.t).alias("a"), tsv.listed_ids(df.t).alias("b"), tsv.parse_ids(df.t).alias("c")).collect()
    assert [list(r) for r in got] == [[["S2-1", "", "S2-1", "S3-2"], ["S2-1", "S2-1", "S3-2"], ["S2-1", "S3-2"]], [[], [], []], [[], [], []], [["", ""], [], []]]
    js = spark.createDataFrame([('["a",null,"é"]',), ("",), (None,)], "t string")
    assert [r.x for r in js.select(tsv.decode_list(js.t).alias("x")).collect()] == [["a", "é"], [], []]
    with pytest.raises(PySparkException):
        spark.createDataFrame([('{"a":1}',)], "t string").select(tsv.decode_list(js.t)).collect()
    arrays = spark.createDataFrame([(["a", "é"], 1)], "x array<string>, y int")
    assert tsv.encode_lists(arrays).first().x == '["a","é"]'


# ---- sources


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("S1-1", 'a "b" c', "NA", "")], "entity_id string, business_name string, business_address string, country string")
    write_tsv(df, str(tmp_path / "t"), 1)
    assert [tuple(r) for r in read_tsv(spark, str(tmp_path / "t")).collect()] == [tuple(df.first())]
    assert read_tsv(spark, str(tmp_path / "t"), decode_missing=True).first().business_address is None
    assert read_tsv(spark, str(tmp_path / "t"), ("country", "entity_id")).columns == ["country", "entity_id"]
    with pytest.raises(FileNotFoundError, match="does not exist"):
        read_tsv(spark, str(tmp_path / "no"))
    with pytest.raises(ValueError, match="price"):
        read_tsv(spark, str(tmp_path / "t"), ("entity_id", "price"))


# ---- blocking and features


def small_records(spark, names=True):
    raw = [("S1-1", "acme trading", "10 main road", "india"), ("S1-2", "", "", "india"), ("S1-3", "duplicate name", "3 third street", "india"), ("S2-1", "acme trading", "10 main road", "india"), ("S2-2", "acme trading", "9 other road", "us"), ("S2-3", "different company", "10 main road", "india"), ("S2-4", "duplicate name", "4 fourth street", "india"), ("S3-1", "acme holdings", "10 main street", "india"), ("S3-2", "duplicate name", "5 fifth street", "india")]
    r = preprocess(spark.createDataFrame(raw, "entity_id string, business_name string, business_address string, country string")).persist()
    return r, r.where("source = 'S1'"), r.where("source <> 'S1'")


def test_rules_on_the_small_set(spark):
    _, s1, c = small_records(spark)
    got = {(r[0], r[1]): r.blocking_rules.split("|") for r in blocking.candidates(blocking.pair_table(s1, c)).collect()}
    assert got["S1-1", "S2-1"] == list(blocking.DEFAULT_RULES) and "name_token" in got["S1-1", "S3-1"] and "address_token" in got["S1-1", "S2-3"]
    assert ("S1-1", "S2-2") not in got and not any(s == "S1-2" for s, _ in got)
    assert {x for (s, x), rules in got.items() if s == "S1-3" and "country_name_exact" in rules} == {"S2-4", "S3-2"}
    two = {tuple(r) for r in blocking.candidates(blocking.pair_table(s1, c), ["name_token_overlap_2"]).select(ID1, ID2).collect()}
    assert ("S1-1", "S2-1") in two and ("S1-1", "S3-1") not in two


def test_config_and_feature_sets():
    with pytest.raises(ValueError):
        blocking.BlockingConfig(name_cap=0)
    with pytest.raises(ValueError):
        blocking.BlockingConfig(rules=("x",))
    assert len(features.BASELINE) == 20 and len(features.feature_set("all")) == 34
    assert [len(features.feature_set(x)) for x in ("baseline", "baseline_plus_cross_field", "baseline_plus_address_cross_field", "baseline_plus_name_address_cross", "name")] == [20, 24, 29, 32, 3]
    assert features.feature_set(["name_ratio", "country_exact"]) == ("name_ratio", "country_exact")
    for bad in ("x", "baseline_plus_x", [], ["name_ratio", "name_ratio"], ["x"]):
        with pytest.raises(ValueError):
            features.feature_set(bad)
    assert list(features.chosen_sets()) == list(features.ABLATION_SETS) and list(features.chosen_sets("baseline, all")) == ["baseline", "all"] and len(features.chosen_sets(robustness=True)) == 5
    assert len(blocking.CONFIGURATIONS) == 16 and set(blocking.SCORED) < set(blocking.CONFIGURATIONS)


def test_features_of_pairs(spark):
    _, s1, c = small_records(spark)
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-3"), ("S1-1", "S2-1")], PAIR)
    got = features.pair_features(pairs, s1, c, features.feature_set("all")).toPandas()
    assert len(got) == 3 and list(got.columns) == [ID1, ID2, "source1_source", "candidate_source", *features.feature_set("all")]
    same = got[got[ID1] == "S1-1"].iloc[0]
    assert all(same[n] == pytest.approx(1) for n in features.feature_set("all") if n not in ("country_missing_either", "country_both_missing"))
    empty = got[got[ID1] == "S1-2"].iloc[0]
    assert empty["name_ratio"] == empty["name_jaccard"] == empty["name_tfidf_cosine"] == empty["name_token_containment_s1"] == 0 and np.isfinite(got[list(features.BASELINE)]).all().all()
    assert features.pair_features(pairs.limit(0), s1, c).count() == 0
    for bad in (("S1-1", "S2-9"), ("S1-9", "S2-1"), ("S2-1", "S2-1"), ("S1-1", "S1-1")):
        with pytest.raises(PySparkException):
            features.pair_features(spark.createDataFrame([bad], PAIR), s1, c, ("name_jaccard",)).collect()
    blank = lambda df: df.withColumn("name_norm", df.name_norm.substr(1, 2))
    short = features.pair_features(pairs, blank(s1), blank(c), ("name_tfidf_cosine",)).collect()
    assert {r.name_tfidf_cosine for r in short if r[0] == "S1-1"} == {1.0}  # no vocabulary: the ratio


def test_numbers_of_addresses(spark):
    df = spark.createDataFrame([(["12", "road"], ["12", "4", "road"])], "a array<string>, b array<string>")
    assert df.select(sim.jaccard(sim.numeric_tokens(df.a), sim.numeric_tokens(df.b)).alias("x")).first().x == 0.5


# ---- checks


def test_checks_raise(spark):
    _, s1, c = small_records(spark)
    frame = lambda *p: spark.createDataFrame(list(p), PAIR)
    for bad, kind in ((frame(("S1-1", "S2-1"), ("S1-1", "S2-1")), "duplicate"), (frame(("S1-1", "S1-1")), "namespace"), (frame(("S1-1", "S2-9")), "unknown"), (frame(("S1-1", None)), "empty")):
        with pytest.raises(ValueError, match=kind):
            submission.aggregate_candidates(bad, s1, c)
    with pytest.raises(ValueError, match="not a candidate"):
        submission.aggregate_matches(frame(("S1-1", "S2-1")), s1, frame(("S1-1", "S2-3")), c)
    assert {r.matched_entity_ids for r in submission.aggregate_matches(frame(("S1-1", "S3-1"), ("S1-1", "S2-1")), s1, None, c).collect()} == {"S2-1,S3-1", ""}
    with pytest.raises(ValueError, match="lacks columns"):
        records.pair_violations(s1)
    with pytest.raises(PySparkException):
        records.prepare_records(s1.withColumn("entity_id", s1.country_norm.substr(1, 0))).collect()
    changed = c.withColumn("name_norm", c.address_norm)
    with pytest.raises(PySparkException):
        records.combine_records(c, changed).collect()
    assert records.combine_records(c, c).count() == c.count()
    words = spark.createDataFrame([("x",), ("1.5",)], "t string")
    assert [r.n for r in words.select(records.numeric(words.t).alias("n")).collect()] == [None, 1.5]
    with pytest.raises(PySparkException):
        words.select(records.numeric(words.t, strict=True)).collect()


def test_violations_and_counts(spark):
    ids = spark.createDataFrame([("S1-1",), ("S1-2",)], f"{ID1} string")
    out = spark.createDataFrame([("S1-1", "S2-1,,S2-1,S1-9")], f"{ID1} string, x string")
    known = spark.createDataFrame([("S2-2",)], "entity_id string")
    assert {(r.kind, r.n) for r in submission.violations(out, "x", ids, known).collect()} == {("missing S1", 1), ("duplicate id", 1), ("namespace", 2), ("unknown id", 2)}
    cand = spark.createDataFrame([("S1-1", "S2-2"), ("S1-2", "")], f"{ID1} string, candidate_entity_ids string")
    match = spark.createDataFrame([("S1-1", "S2-2"), ("S1-2", "")], f"{ID1} string, matched_entity_ids string")
    assert submission.validate_submission(cand, match, ids, known) == {"s1_count": 2, "candidate_pair_count": 1, "predicted_match_count": 1, "zero_candidate_s1_count": 1, "zero_match_s1_count": 1}
    with pytest.raises(ValueError, match="not a candidate"):
        submission.validate_submission(cand.replace("S2-2", ""), match, ids, known)
    with pytest.raises(ValueError, match="exactly"):
        submission.validate_submission(match, match, ids, known)


# ---- evaluation


def test_known_scores(spark):
    truth = spark.createDataFrame([("S1-1", "S2-1,S2-2"), ("S1-2", ""), ("S1-3", "S3-1"), ("S1-1", "S2-1")], f"{ID1} string, matched_entity_ids string")
    scored = spark.createDataFrame([("S1-1", "S2-1", 0.9), ("S1-1", "S2-2", 0.9), ("S1-1", "S2-3", 0.9)], PAIR + ", match_probability double")
    t = evaluate.truth_links(truth)
    got = evaluate.threshold_report(scored, t, truth, [0.5]).first()
    assert got.macro_f05 == pytest.approx((5 / 7 + 1 + 0) / 3) and (got.tp, got.fp, got.fn, got.available, got.lost, got.missed) == (2, 1, 1, 2, 1, 0)
    assert evaluate.link_counts(scored, t, 0.95).first().asDict() == {"candidate_true_links": 2, "candidate_loss_links": 1, "true_positive_links": 0, "false_positive_links": 0, "model_fn_among_candidates": 2, "false_negative_links": 3, "predicted_links": 0, "link_precision": 0.0, "link_recall": 0.0}
    assert evaluate.truth_summary(truth).first().asDict() == {"s1_entities": 3, "ground_truth_rows": 4, "empty_truth_entities": 1, "positive_links": 4, "s2_links": 3, "s3_links": 1}
    ties = spark.createDataFrame([(0.1, 0.5), (0.3, 0.5), (0.2, 0.4)], "threshold double, macro_f05 double")
    assert evaluate.best_threshold(ties).first().threshold == 0.3 and evaluate.best_threshold(ties.limit(0)).first().threshold == 0.5
    with pytest.raises(ValueError):
        evaluate.fbeta(1, 1, -1)


def test_diagnostics_of_known_features(spark):
    df = spark.createDataFrame([(0, 0.0, 3.0, None), (1, 1.0, 3.0, 2.0), (1, 0.8, 3.0, None)], "label int, a double, b double, c double")
    got = {r.feature: r for r in evaluate.diagnose(df, ("a", "b", "c")).collect()}
    assert got["a"].univariate_auc == 1.0 and got["b"].univariate_auc == 0.5 and got["b"].constant and got["c"].missing_rate == pytest.approx(2 / 3) and got["c"].unique_values == 1
    assert got["a"].positive_mean == pytest.approx(0.9) and got["a"].positive_std == pytest.approx(0.1) and not got["a"].nearly_constant and got["a"].dtype == "double"
    assert evaluate.correlations(df, ("a", "b")).first().correlation is None


def test_comparisons_of_runs(spark):
    runs = spark.createDataFrame([("baseline", 1, 0.8), ("baseline", 2, 0.9), ("x", 1, 0.84), ("x", 2, 0.89)], "feature_set string, seed int, validation_macro_f0_5 double")
    d = errors.paired_differences(runs)
    assert sorted(round(r.paired_improvement, 9) for r in d.collect()) == [-0.01, 0.04] and errors.paired_summary(d).first()["mean"] == pytest.approx(0.015)
    assert errors.paired_summary(d.limit(1)).first().paired_improvement_std == 0
    base = errors.aggregate_results(runs).where("feature_set = 'baseline'").first()
    assert base.validation_macro_f0_5_std == pytest.approx(0.05) and base.seeds == 2
    for bad in (runs.where("not (feature_set = 'baseline' and seed = 2)"), runs.union(runs.limit(1))):
        with pytest.raises(ValueError):
            errors.paired_differences(bad)
    with pytest.raises(ValueError):
        errors.error_rows(runs, 0.5, "x")


def test_splits(spark):
    truth = spark.createDataFrame([(f"S1-{i % 50}", "") for i in range(80)], f"{ID1} string, matched_entity_ids string")
    for split in (splits.split_by_s1, splits.split_shuffled):
        train, held = split(truth, 0.3, 7)
        a, b = ({r[0] for r in x.collect()} for x in (train, held))
        assert not a & b and len(a | b) == 50 and b and train.count() + held.count() == 80
        again = {r[0] for r in split(truth.repartition(5) if split is splits.split_by_s1 else truth, 0.3, 7)[1].collect()}
        assert again == b
        with pytest.raises(ValueError):
            split(truth, 1.0)
    ids = np.array([f"S1-{i}" for i in range(50)], dtype=object)
    np.random.default_rng(7).shuffle(ids)
    assert b == set(ids[:15])
    assert splits.split_by_s1(truth.limit(1), 0.01)[1].count() == 1
    assert splits.sample(spark.createDataFrame([(f"S1-{i}",) for i in range(30)], "entity_id string"), 10).count() == 10


# ---- models


def test_logistic_as_newton_in_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((300, 2))
    y = (x[:, 0] + 0.3 * rng.standard_normal(300) > 0.8).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(k)) for r, k in zip(x, y)], "a double, b double, label int")
    model = models.LogisticScorer().fit(df, ("a", "b"))
    w, z, beta = np.where(y == 1, 150 / y.sum(), 150 / (300 - y.sum())), np.column_stack([x, np.ones(300)]), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ beta))
        beta -= np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + np.eye(3), z.T @ (w * (p - y)) + beta)
    assert np.allclose([*model.coef_, model.intercept_], beta)
    assert [r.feature for r in models.coefficients(model, ("a", "b")).collect()] == ["a", "b"] and model.class_weight == "balanced"
    assert models.LogisticScorer().fit(df.where("label = 1"), ("a",)).predict(df).first().match_probability == 1.0
    assert models.LogisticScorer().fit(df.limit(0), ("a",)).predict(df).first().match_probability == 0.0
    with pytest.raises(RuntimeError):
        models.LogisticScorer().predict(df)
    with pytest.raises(ValueError):
        models.LogisticScorer().fit(df, ("c",))
    with pytest.raises(ValueError, match="both positive and negative"):
        models.BoostedScorer().fit(df.where("label = 1"), ("a",))
    boosted = models.make(models.BoostedScorer, 3)
    boosted.rounds = 5
    got = boosted.fit(df, ("a", "b")).predict(df).toPandas()
    assert boosted.random_state == 3 and got.match_probability.between(0, 1).all() and got[got.label == 1].match_probability.mean() > got[got.label == 0].match_probability.mean()
    assert models.coefficients(boosted, ("a",)).count() == 0 and isinstance(models.make(models.BestOf), models.BestOf)


# ---- from raw records to results


def test_link(spark):
    raw = raw_records(spark, SF)
    truth = Q["rule_country_name_exact"](spark, SF).withColumnRenamed("candidate_entity_id", "matched_entity_id")
    scored, lists = link(raw, truth, raw, models.LogisticScorer(), 0.5, names=("name_jaccard", "address_jaccard"))
    assert scored.where("match_probability not between 0 and 1").isEmpty()
    assert lists.count() == raw.where("entity_id like 'S1%'").count()
    spark.catalog.clearCache()


def test_pipeline_refuses_wrong_input(spark):
    r, _, _ = small_records(spark)
    truth = spark.createDataFrame([("S1-1", "S2-1")], f"{ID1} string, matched_entity_ids string")
    with pytest.raises(ValueError, match="threshold"):
        run_pipeline(r, truth, r, threshold=2)
    with pytest.raises(ValueError, match="namespace"):
        run_pipeline(r, truth.replace("S1-1", "S2-1", ID1), r)
    with pytest.raises(ValueError, match="conflicting"):
        run_pipeline(r, truth, r.withColumn("name_norm", r.address_norm))
    with pytest.raises(ValueError, match="duplicate"):
        run_pipeline(r.union(r), truth, r)
    with pytest.raises(ValueError, match="both positive and negative"):
        run_pipeline(r, truth.limit(0), r, names=("name_jaccard",))


def world(tmp_path):
    names = ["acme trading", "duplicate name", "blue river mills", "green hill farms", "old town bakery", "north star travel", "silver line metals", "red brick house"]
    for split in ("train", "test"):
        os.makedirs(tmp_path / split)
        for k in (1, 2, 3):
            lines = ["entity_id\tbusiness_name\tbusiness_address\tcountry"] + [f"S{k}-{i}\t{n}{' ltd' * (k - 1)}\t{i} {n.split()[0]} road\tindia" for i, n in enumerate(names)]
            (tmp_path / split / f"{split}_source{k}.tsv").write_text("\n".join(lines) + "\n")
    (tmp_path / "train" / "train_ground_truth.tsv").write_text(f"{ID1}\tmatched_entity_ids\n" + "".join(f"S1-{i}\tS2-{i},S3-{i}\n" if i else "S1-0\t\n" for i in range(8)))


def test_command_line(spark, tmp_path, capsys):
    world(tmp_path)
    out = str(tmp_path / "out")
    assert cli.main(["submission", str(tmp_path), out, "--scorer", "logistic", "--threshold", "0.5", "--evaluation", str(tmp_path / "train" / "train_ground_truth.tsv")]) == 0
    assert "'validation_status': 'passed'" in capsys.readouterr().out
    assert cli.main(["validate", f"{out}/candidates.tsv", f"{out}/matches.tsv", str(tmp_path / "test")]) == 0
    assert cli.main(["validate", f"{out}/matches.tsv", f"{out}/matches.tsv", str(tmp_path / "test")]) == 1 and "error:" in capsys.readouterr().err
    assert cli.main(["preprocess", str(tmp_path / "none.tsv"), out]) == 1
    for k in (1, 2, 3):
        assert cli.main(["preprocess", str(tmp_path / "train" / f"train_source{k}.tsv"), str(tmp_path / "processed" / f"train_source{k}.tsv")]) == 0
    processed, truth = str(tmp_path / "processed"), str(tmp_path / "train" / "train_ground_truth.tsv")
    assert cli.main(["candidates", processed, f"{out}/pairs.tsv", "--include-metadata"]) == 0
    assert read_tsv(spark, f"{out}/pairs.tsv", (ID1, ID2, "candidate_source", "blocking_rules")).where("candidate_source in ('S2', 'S3')").count() >= 16
    assert cli.main(["blocking", processed, truth, f"{out}/blocking"]) == 0
    assert cli.main(["sample", str(tmp_path / "train"), f"{out}/sample", "--n", "3"]) == 0
    assert read_tsv(spark, f"{out}/sample/train_source1.tsv").count() == 3
    assert cli.main(["archive", str(tmp_path / "a.zip"), out]) == 0 and cli.main(["archive", str(tmp_path / "a.zip"), "/none"]) == 1
    assert cli.rss_mb() > 1
    spark.catalog.clearCache()


def test_experiments(spark):
    r = prepared(raw_records(spark, SF)).select(*records.PROCESSED, "source")
    s1, c = r.where("source = 'S1'"), r.where("source <> 'S1'")
    pairs = Q["rule_name_token_overlap_2"](spark, SF).groupBy(ID1).agg({ID2: "min"}).toDF(ID1, "matched_entity_ids")
    truth = s1.selectExpr(f"entity_id as {ID1}").join(pairs, ID1, "left").fillna("").persist()
    names = ("name_jaccard", "address_jaccard", "country_exact", "name_exact", "address_exact")
    rows_, reports = experiments.run_experiment(s1, c, truth, names, ("strict_overlap_2",), models.BestOf)
    one = rows_[0]
    assert len(one) == 33 and one["false_negative_links"] == one["blocked_out_validation_links"] + one["model_fn_among_candidates"] and one["feature_rows"] == one["candidates"]
    assert {(x.stage, x.configuration) for x in reports.select("stage", "configuration").distinct().collect()} == {("development", "strict_overlap_2"), ("validation", "strict_overlap_2")}
    out = experiments.run_ablation(s1, c, truth, {"baseline": names[:2], "baseline_plus_address": names}, (2,), models.BestOf)
    assert out["per_seed"].count() == 2 and {x.seeds for x in out["aggregate"].collect()} == {1}
    assert errors.paired_differences(out["per_seed"]).count() == 1
    lost = experiments.error_artifact(out, r, seed=2)
    assert {"error_type", "s1_name_norm", "feature_set"} <= set(lost.columns) and lost.where("seed <> 2").isEmpty()
    with pytest.raises(ValueError):
        experiments.error_artifact(out, r, "x")
    tables, summary = experiments.run_audit(s1, c, truth, names=names)
    assert len(tables) == 9 and tables["model_coefficients"].count() == len(names) and summary["validation_false_positives"] >= summary["validation_high_confidence_false_positives_emitted"]
    assert tables["validation_error_summary"].where("dimension = 'score_band'").count() in (0, 6)
    spark.catalog.clearCache()


def test_streams_meet_static_records(spark, tmp_path):
    raw = "entity_id string, business_name string, business_address string, country string"
    spark.createDataFrame([("S1-1", "Acme & Co", "", "IN"), ("S1-2", "", "", ""), ("S1-3", "acme and company", "", "US")], raw).write.parquet(str(tmp_path / "in"))
    static = preprocess(spark.createDataFrame([("S2-1", "acme and company", "", "in"), ("S2-2", "acme and company", "", ""), ("S2-3", "", "", "")], raw))
    q = exact_matches(spark.readStream.schema(raw).parquet(str(tmp_path / "in")), static).writeStream.format("memory").queryName("met").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.table("met").collect()} == {("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-3", "S2-2")}


def test_pareto(spark):
    report = spark.createDataFrame([("a", 10, 5.0, 6.0, 0.9), ("b", 12, 5.0, 6.0, 0.9), ("c", 9, 9.0, 9.0, 0.5), ("d", 10, 5.0, 6.0, 0.9)], "configuration string, candidates long, p95 double, p99 double, recall double")
    assert [r.configuration for r in blocking.pareto(report).collect()][0] == "c" and {r.configuration for r in blocking.pareto(report).collect()} == {"a", "c", "d"}
    assert evaluate.reduction_ratio(5, 2, 5) == 0.5 and evaluate.reduction_ratio(0, 0, 5) == 0.0


# ---- pairs carry texts, not vectors or lists


def slow_cosines(texts, pairs):
    """By the definition, from counts of grams."""
    bags = [Counter(t[i:i + n] for n in (3, 4, 5) for i in range(len(t) - n + 1)) for t in texts]
    df = Counter(g for b in bags for g in b)
    vectors = [{g: k * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, k in b.items()} for b in bags]
    size = [math.sqrt(sum(x * x for x in v.values())) for v in vectors]
    return [sum(x * vectors[j].get(g, 0) for g, x in vectors[i].items()) / (size[i] * size[j]) if size[i] * size[j] else 0.0 for i, j in pairs]


def test_cosines_equal_the_definition(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab é日𝒳") for _ in range(rng.choice((0, 2, 3, 4, 30, 700)))) for _ in range(60)] + ["aaaa" * 9, "aaaa" * 9]
    ids = [f"S{1 + (k % 3)}-{k}" for k in range(len(texts))]
    r = preprocess(spark.createDataFrame([(i, "", "", "") for i in ids], "entity_id string, business_name string, business_address string, country string"))
    r = r.drop("name_norm").join(spark.createDataFrame(list(zip(ids, texts)), "entity_id string, name_norm string"), "entity_id")
    pairs = [(i, j) for i in range(0, len(ids), 3) for j in range(len(ids)) if j % 3]
    s1, c = r.where("source = 'S1'"), r.where("source <> 'S1'")
    got = features.pair_features(spark.createDataFrame([(ids[i], ids[j]) for i, j in pairs], PAIR), s1, c, ("name_tfidf_cosine",)).collect()
    got = {(x[0], x[1]): x.name_tfidf_cosine for x in got}
    assert [got[ids[i], ids[j]] for i, j in pairs] == pytest.approx(slow_cosines(texts, pairs), abs=1e-9)


def test_grams_that_share_a_slot_count_each():
    rng = random.Random(7)
    few = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(900)) for _ in range(3)]  # 2,700 grams each, in 2^16 slots
    many = few + ["".join(rng.choice(few)[k:k + 300] for k in (0, 500)) for _ in range(5)]
    none = sim.Idf(len(few) + len(many), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), 3, 5)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(3), np.arange(len(many))))
    bags = lambda t: Counter(t[k:k + n] for n in (3, 4, 5) for k in range(len(t) - n + 1))
    want = [sum(k * bags(many[y])[g] for g, k in bags(few[x]).items()) * none.rare ** 2 for x, y in zip(i, j)]
    assert sim._dots(few, many, i, j, none) == pytest.approx(want)


def test_pairs_carry_no_lists_and_lists_of_their_own_stay(spark):
    _, s1, c = small_records(spark)
    pairs = spark.createDataFrame([("S1-1", "S2-1")], PAIR)
    f = features.pair_features(pairs, s1, c, ("name_tfidf_cosine",))
    assert "array" not in f._jdf.queryExecution().optimizedPlan().toString().split("Join")[0] and "collect_list" not in f._jdf.queryExecution().toString()
    other = c.withColumn("name_tokens", F.array(F.lit("x"))).withColumn("name_char_ngrams", F.array(F.lit("y")))
    got = features.pair_features(pairs, s1, other, ("name_jaccard", "name_char_ngram_jaccard", "address_jaccard")).first()
    assert (got.name_jaccard, got.name_char_ngram_jaccard, got.address_jaccard) == (0, 0, 1)


# ---- many pairs of texts at once


def _some_texts(n, size, seed):
    r = np.random.default_rng(seed)
    words = ["de", "la", "ción", "7", "٣", "a", "mente", "12b", "os"] + ["".join(r.choice(list("aeionrst"), r.integers(2, 9))) for _ in range(300)]
    return [" ".join(r.choice(words, size))[:6 * size] for _ in range(n)]


def test_ratios_take_little_time():
    a, b = [x for x in _some_texts(100, 13, 1) for _ in range(40)], _some_texts(4000, 13, 2)
    sim.partial(a[:10], b[:10])
    began = time.process_time()
    for f in (sim.indel, sim.token_sets, sim.sorted_tokens, sim.partial):
        f(a, b)
    assert (time.process_time() - began) / len(a) < 200e-6  # 460e-6 and more with windows one by one


def test_compared_as_brute_force():
    a, b = _some_texts(150, 5, 3) + _some_texts(6, 60, 4) + ["", "", "a", "a a", "7", "b  a", " ", "漢字 か", "x" * 300], _some_texts(150, 5, 5) + _some_texts(6, 70, 6) + ["", "a", "a", "a", "٣", "a b", "a", "か 漢", "x" * 299 + "y"]
    got = sim.compared(a, b, tuple(sim.COMPARED))
    either = lambda x, y, of: 1.0 if not x and not y else 0.0 if not x or not y else len(x & y) / of
    for i, (x, y) in enumerate(zip(a, b)):
        s, t = ({*z.split(" ")} if z else set() for z in (x, y))
        g, h = ({f"^{z}$"[k:k + 3] for k in range(len(z))} for z in (x, y))
        u, v = ({w for w in z if any(map(str.isdecimal, w))} for z in (s, t))
        want = {"jaccard": either(s, t, len(s | t)), "overlap": either(s, t, min(len(s), len(t))), "char_ngram_jaccard": either(g, h, len(g | h)), "token_containment_s1": either(s, t, len(s)), "token_containment_candidate": either(s, t, len(t)), "numeric_jaccard": either(u, v, len(u | v)), "numeric_overlap": either(u, v, min(len(u), len(v)))}
        want |= {"ratio": slow_ratio(x, y), "token_set_ratio": slow_sets(x, y), "token_sort_ratio": slow_ratio(" ".join(sorted(x.split())), " ".join(sorted(y.split())))}
        want |= {"partial_ratio": slow_partial(x, y)} if len(x) + len(y) < 120 else {}
        assert {n: got[n][i] for n in want} == want, (x, y)


def test_sets_follow_lists_that_differ_from_the_text(spark):
    rows = [("S1-1", "ab cd", ["ab", "cd"], ["x"]), ("S2-2", "ab ce", ["zz", "cd"], ["x", "y"]), ("S2-3", "ab ce", ["ab", "ce"], None)]
    r = spark.createDataFrame(rows, "entity_id string, name_norm string, name_tokens array<string>, grams array<string>")
    r = r.selectExpr("entity_id", "name_norm", "name_norm as address_norm", "'' as country_norm", "name_tokens", "name_tokens as address_tokens", "grams as name_char_ngrams", "grams as address_char_ngrams")
    pairs = spark.createDataFrame([("S1-1", "S2-2"), ("S1-1", "S2-3")], PAIR)
    names = ("name_jaccard", "name_overlap", "name_char_ngram_jaccard", "address_token_containment_s1", "name_ratio")
    got = {x[1]: tuple(x[4:]) for x in features.pair_features(pairs, r.where("entity_id = 'S1-1'"), r.where("entity_id <> 'S1-1'"), names).collect()}
    assert got["S2-2"] == pytest.approx((1 / 3, 0.5, 0.5, 0.5, 0.8)) and got["S2-3"][:2] == pytest.approx((1 / 3, 0.5)) and got["S2-3"][3:] == pytest.approx((0.5, 0.8))
