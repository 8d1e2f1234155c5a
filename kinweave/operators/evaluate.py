"""Reports on candidates, scores and features."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .records import ID1, ID2


def fbeta(p, r, beta: float = 0.5):
    if beta < 0:
        raise ValueError("beta must not be negative")
    return F.coalesce(F.try_divide((1 + beta * beta) * p * r, beta * beta * p + r), F.lit(0.0))


def truth_links(truth: DataFrame) -> DataFrame:
    """(source1_entity_id, matched_entity_id) of comma-separated lists."""
    from ..sources.tsv import parse_ids

    return truth.select("source1_entity_id", F.explode(parse_ids(F.col("matched_entity_ids"))).alias("matched_entity_id")).distinct()


PERCENTILES = {"median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def pairs_of(links: DataFrame) -> DataFrame:
    """Distinct links as (source1_entity_id, candidate_entity_id, t = 1)."""
    return links.select(ID1, F.col("matched_entity_id").alias(ID2), F.lit(1).alias("t")).distinct()


def candidates_by_s1(cands: DataFrame, links: DataFrame, universe: DataFrame) -> DataFrame:
    """Per S1 of the universe or the candidates: candidates, true links, retrieved links and recall (null without links)."""
    pairs = cands.select(ID1, ID2).distinct()
    both = pairs.withColumn("p", F.lit(1)).join(pairs_of(links), [ID1, ID2], "full")
    per = both.groupBy(ID1).agg(F.count("p").alias("candidate_count"), F.count("t").alias("truth_count"), F.count_if(F.col("p").isNotNull() & F.col("t").isNotNull()).alias("retrieved_count"))
    ids = universe.select(ID1).union(pairs.select(ID1)).distinct()
    return ids.join(per, ID1, "left").fillna(0).withColumn("recall", F.try_divide("retrieved_count", "truth_count"))


def _distribution(c, prefix: str = "") -> list:
    """Aggregates of a count; nulls are left out, and without any value all are 0."""
    some = [F.count(c).alias("entities"), F.avg(c).alias("mean"), *[F.percentile(c, F.lit(x)).alias(n) for n, x in PERCENTILES.items()], F.max(c).alias("max"), F.count_if(c == 0).alias("zero"), F.count_if(c == 1).alias("one"), *[F.count_if(c <= n).alias(f"le_{n}") for n in (5, 10, 20, 50, 100)], F.count_if(c > 100).alias("gt_100")]
    names = ["entities", "mean", *PERCENTILES, "max", "zero", "one", *[f"le_{n}" for n in (5, 10, 20, 50, 100)], "gt_100"]
    return [F.coalesce(x, F.lit(0)).alias(prefix + n) for x, n in zip(some, names)]


def distribution(per_s1: DataFrame) -> DataFrame:
    """Summary of candidate_count in one row; zeros where there is none."""
    return per_s1.agg(*_distribution(F.col("candidate_count")))


def population_distributions(per_s1: DataFrame) -> DataFrame:
    """A distribution for all S1 entities, those with true links and those without; one pass over the rows."""
    kind = F.explode(F.array(F.lit("all_s1"), F.when(F.col("truth_count") > 0, "s1_with_truth").otherwise("s1_without_truth"))).alias("population")
    names = per_s1.sparkSession.createDataFrame([(n,) for n in ("all_s1", "s1_with_truth", "s1_without_truth")], "population string")
    got = per_s1.select(kind, "candidate_count").groupBy("population").agg(*_distribution(F.col("candidate_count")))
    return names.join(got, "population", "left").fillna(0)


def report(pairs: DataFrame, sets: dict[str, str], links: DataFrame, universe: DataFrame) -> DataFrame:
    """Recall and candidate counts of each named condition on the pair table (s, c, facts), a row each, from one pass over the pairs.

    Links of S1 entities outside the universe count in recall, not in distributions.
    """
    t = links.select(F.col(ID1).alias("s"), F.col("matched_entity_id").alias("c"), F.lit(1).alias("t")).distinct()
    named = F.explode(F.array_compact(F.array(*[F.when(F.expr(cond), F.lit(name)) for name, cond in sets.items()]))).alias("configuration")
    hits = pairs.join(t, ["s", "c"], "left").select("s", "c", "t", named)
    of = lambda n: F.col("c").startswith(n)
    per = hits.groupBy("configuration", "s").agg(F.count("*").alias("n"), F.count("t").alias("hit"), F.count_if(F.col("t").isNotNull() & of("S2-")).alias("hit2"), F.count_if(F.col("t").isNotNull() & of("S3-")).alias("hit3"))
    true = t.groupBy("s").agg(F.count("*").alias("links"), F.count_if(of("S2-")).alias("links2"), F.count_if(of("S3-")).alias("links3"))
    known = universe.select(F.col(ID1).alias("s")).union(pairs.select("s")).distinct().withColumn("known", F.lit(True))
    ids = known.join(true, "s", "full").withColumn("configuration", F.explode(F.array(*[F.lit(n) for n in sets])))
    rows = ids.join(per, ["configuration", "s"], "left").fillna(0, ["n", "hit", "hit2", "hit3", "links", "links2", "links3"]).fillna(False, ["known"])
    count = F.when(F.col("known"), F.col("n"))
    share = lambda a, b: F.coalesce(F.try_divide(F.sum(a), F.sum(b)), F.lit(0.0))
    facts = [F.sum("n").alias("candidate_count"), F.sum("links").alias("true_match_count"), F.sum("hit").alias("true_matches_retrieved"), share("hit", "links").alias("blocking_recall")]
    for k in (2, 3):
        facts += [F.sum(f"links{k}").alias(f"s{k}_true_match_count"), F.sum(f"hit{k}").alias(f"s{k}_true_matches_retrieved"), share(f"hit{k}", f"links{k}").alias(f"s{k}_recall")]
    matched, zero = F.when(F.col("links") > 0, count), F.when(F.col("links") == 0, count)
    return rows.groupBy("configuration").agg(*facts, *_distribution(count), *_distribution(matched, "matched_"), *_distribution(zero, "zero_match_"))


def evaluate_candidates(cands: DataFrame, links: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: recall over all links, and those to S2 and S3, and candidate counts of all, matched and unmatched S1 entities."""
    pairs = cands.select(F.col(ID1).alias("s"), F.col(ID2).alias("c")).distinct()
    return report(pairs, {"all": "true"}, links, universe).drop("configuration")


def configuration_rows(found: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Short columns of a report, with the rules of each configuration."""
    names = found.sparkSession.createDataFrame(list(rules.items()), "configuration string, rules string")
    return found.join(names, "configuration", "left").select("configuration", "rules", F.col("candidate_count").alias("candidates"), "mean", "median", "p90", "p95", "p99", "max", F.col("blocking_recall").alias("recall"), "s2_recall", "s3_recall", (F.col("true_match_count") - F.col("true_matches_retrieved")).alias("missed_true_links"))


def truth_summary(truth: DataFrame) -> DataFrame:
    """One row: entities, rows, rows without links, links, and those to S2 and S3; a row's repeated ids count once."""
    from ..sources.tsv import parse_ids

    ids = truth.select(F.trim(F.coalesce(ID1, F.lit(""))).alias("s"), parse_ids(F.col("matched_entity_ids")).alias("ids"))
    of = lambda n: F.size(F.filter("ids", lambda x: x.startswith(n)))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    return ids.agg(F.count_distinct("s").alias("s1_entities"), F.count("*").alias("ground_truth_rows"), F.count_if(F.size("ids") == 0).alias("empty_truth_entities"), total(F.size("ids")).alias("positive_links"), total(of("S2-")).alias("s2_links"), total(of("S3-")).alias("s3_links"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    """Positive pairs with label 1, one for each id of each row; repeated rows repeat them."""
    from ..sources.tsv import parse_ids

    return truth.select(F.trim(ID1).alias(ID1), F.explode(parse_ids(F.col("matched_entity_ids"))).alias(ID2), F.lit(1).alias("label"))


def predictions(scored: DataFrame, threshold: float, truth_ids: DataFrame | None = None, column: str = "match_probability") -> DataFrame:
    """(source1_entity_id, candidates): the distinct candidates at or over the threshold, sorted; empty for S1 entities of scored, or truth_ids, with none."""
    ids = scored.select(ID1)
    if truth_ids is not None:
        ids = ids.union(truth_ids.select(ID1))
    chosen = F.collect_set(F.when(F.col(column) >= threshold, F.col(ID2)))
    got = scored.groupBy(ID1).agg(F.array_sort(chosen).alias("candidates"))
    return ids.distinct().join(got, ID1, "left").withColumn("candidates", F.coalesce("candidates", F.array().cast("array<string>")))


def reduction_ratio(pairs: int, s1: int, others: int) -> float:
    return 1 - pairs / (s1 * others) if s1 and others else 0.0


def threshold_report(scored: DataFrame, links: DataFrame, universe: DataFrame, thresholds=None, column: str = "match_probability") -> DataFrame:
    """Per threshold: link counts, precision, recall and the macro F0.5 over the universe, in one pass.

    Lost links are true ones that no candidate pair has; missed ones are pairs
    under the threshold. Each pair gives its rows only for thresholds that it
    meets, so the counts by S1 come from one aggregation.
    """
    grid = list(thresholds if thresholds is not None else [i * 0.05 for i in range(21)])
    t = pairs_of(links)
    marks = F.array(*[F.lit(float(x)) for x in grid])
    pairs = scored.select(ID1, ID2, F.col(column).alias("p")).distinct()
    hits = pairs.join(t, [ID1, ID2], "left").select(ID1, "t", F.explode(F.filter(marks, lambda x: F.col("p") >= x)).alias("threshold"))
    per = hits.groupBy(ID1, "threshold").agg(F.count("*").alias("n"), F.count("t").alias("tp"))
    available = pairs.select(ID1, ID2).distinct().join(t.select(ID1, ID2), [ID1, ID2], "left_semi").groupBy(ID1).agg(F.count("*").alias("available"))
    all_s1 = universe.select(ID1).distinct().withColumn("known", F.lit(True)).join(t.groupBy(ID1).agg(F.count("*").alias("links")), ID1, "full").join(available, ID1, "left").join(scored.select(ID1).distinct().withColumn("seen", F.lit(True)), ID1, "full")
    rows = all_s1.select("*", F.explode(marks).alias("threshold")).join(per, [ID1, "threshold"], "left").fillna(0, ["n", "tp", "links", "available"])
    p, r = F.coalesce(F.try_divide("tp", "n"), F.lit(0.0)), F.coalesce(F.try_divide("tp", "links"), F.lit(0.0))
    f = F.when(F.col("known"), F.when((F.col("n") == 0) & (F.col("links") == 0), 1.0).otherwise(fbeta(p, r)))
    total = lambda x: F.sum(x).cast("long")
    out = rows.withColumn("f", f).groupBy("threshold").agg(total("tp").alias("tp"), total(F.col("n") - F.col("tp")).alias("fp"), total(F.col("links") - F.col("tp")).alias("fn"), total("available").alias("available"), total(F.col("links") - F.col("available")).alias("lost"), total(F.col("available") - F.col("tp")).alias("missed"), total("n").alias("predicted"), F.coalesce(F.avg("f"), F.lit(0.0)).alias("macro_f05"))
    return out.withColumns({"precision": F.coalesce(F.try_divide("tp", "predicted"), F.lit(0.0)), "recall": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0))})


def link_counts(scored: DataFrame, links: DataFrame, threshold: float, column: str = "match_probability") -> DataFrame:
    """One row of link counts at a threshold: available, lost before scoring, true and false positives, missed by the scorer, all missed, predicted, precision and recall."""
    p = scored.groupBy(ID1, ID2).agg(F.max(column).alias("p"))
    both = p.withColumn("k", F.lit(1)).join(pairs_of(links), [ID1, ID2], "full")
    true, cand, chosen = F.col("t").isNotNull(), F.col("k").isNotNull(), F.coalesce(F.col("p") >= threshold, F.lit(False))
    n = {"candidate_true_links": true & cand, "candidate_loss_links": true & ~cand, "true_positive_links": true & chosen, "false_positive_links": ~true & chosen, "model_fn_among_candidates": true & cand & ~chosen, "false_negative_links": true & ~chosen, "predicted_links": chosen, "__true": true}
    row = both.agg(*[F.count_if(c).alias(k) for k, c in n.items()])
    share = lambda b: F.coalesce(F.try_divide("true_positive_links", b), F.lit(0.0))
    return row.withColumns({"link_precision": share("predicted_links"), "link_recall": share("__true")}).drop("__true")


def best_threshold(report: DataFrame) -> DataFrame:
    """One row: the threshold of best macro F0.5, the higher one of ties; 0.5 without rows.

    Scores that differ by rounding of sums alone, under 1e-9, are ties.
    """
    return report.agg(F.coalesce(F.max_by("threshold", F.struct(F.round("macro_f05", 9), "threshold")), F.lit(0.5)).alias("threshold"))


def _long(features: DataFrame, names, label=None) -> DataFrame:
    items = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).cast("double").alias("v")) for n in names])).alias("x")
    return features.select(*([label] if label else []), items).select(*([label] if label else []), "x.feature", "x.v")


def diagnose(features: DataFrame, names, label: str = "label") -> DataFrame:
    """Per feature: type, rates, distinct values, whether it is constant or nearly, mean, deviation and median, all and by class, effect size and AUC.

    Nearly constant is two values at most, or one, null among them, that 99 % of rows have.
    """
    kinds = dict(features.dtypes)
    rows = _long(features, names, label)
    v, side = F.col("v"), {"positive": F.when(F.col(label) == 1, F.col("v")), "negative": F.when(F.col(label) == 0, F.col("v"))}
    by_value = rows.groupBy("feature", "v").agg(F.sum((F.col(label) == 1).cast("long")).alias("p"), F.sum((F.col(label) == 0).cast("long")).alias("q"), F.count("*").alias("k"))
    stats = rows.groupBy("feature").agg(
        F.avg(v.isNull().cast("double")).alias("missing_rate"), F.avg(F.coalesce(v == 0, F.lit(False)).cast("double")).alias("zero_rate"), F.avg(v).alias("overall_mean"), F.stddev_pop(v).alias("overall_std"),
        F.count_if(F.col(label) == 1).alias("positive_count"), F.count_if(F.col(label) == 0).alias("negative_count"),
        *[f(x).alias(f"{k}_{n}") for k, x in side.items() for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("median", lambda x: F.percentile(x, F.lit(0.5))))])
    # a row per value first, so that the running sum is over values and not pairs
    w = Window.partitionBy("feature").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    below = by_value.withColumn("below", F.coalesce(F.sum(F.when(v.isNotNull(), F.col("q"))).over(w), F.lit(0)))
    there = lambda x: F.sum(F.when(v.isNotNull(), F.col(x)))
    auc = below.groupBy("feature").agg(F.count("v").alias("unique_values"), F.try_divide(F.max("k"), F.sum("k")).alias("dominant"), F.try_divide(F.sum(F.when(v.isNotNull(), F.col("p") * (F.col("below") + F.col("q") / 2))), there("p") * there("q")).alias("univariate_auc"))
    difference = F.col("positive_mean") - F.col("negative_mean")
    pooled = F.sqrt((F.col("positive_std") ** 2 + F.col("negative_std") ** 2) / 2)
    kind = F.create_map(*[F.lit(x) for n in names for x in (n, kinds[n])])
    out = stats.join(auc, "feature").withColumns({"dtype": kind[F.col("feature")], "constant": F.col("unique_values") <= 1, "nearly_constant": (F.col("unique_values") <= 2) | (F.col("dominant") >= 0.99), "mean_difference": difference, "standardized_mean_difference": F.try_divide(difference, pooled)})
    return out.drop("dominant")


def correlations(features: DataFrame, names) -> DataFrame:
    """Pearson correlations above the diagonal, null where a feature is constant."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    exprs = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)).alias("correlation")) for a, b in pairs]
    return features.agg(F.array(*exprs).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def score_bands(scored: DataFrame) -> DataFrame:
    """Pairs per band of score, empty bands included."""
    cuts = (0.25, 0.5, 0.75, 0.9, 0.95)
    band = sum(((F.col("match_probability") >= c).cast("int") for c in cuts), F.lit(0))
    n = scored.groupBy(band.alias("band")).agg(F.count("*").alias("pairs"))
    return scored.sparkSession.range(len(cuts) + 1).select(F.col("id").cast("int").alias("band")).join(n, "band", "left").fillna(0)
