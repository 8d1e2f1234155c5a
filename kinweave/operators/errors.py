"""Errors of a scorer and comparisons of experiment runs."""
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import with_record
from .records import ID1, ID2, as_text
from .splits import blocked_links

CONTEXT = ("name_norm", "address_norm", "country_norm")
#: Left edges of score bands and their names.
BANDS = ((None, "<0.25"), (0.25, "0.25-0.50"), (0.5, "0.50-0.75"), (0.75, "0.75-0.90"), (0.9, "0.90-0.95"), (0.95, ">=0.95"))
METRICS = ("macro_f0_5", "precision", "recall", "threshold", "validation_macro_f0_5", "validation_precision", "validation_recall", "candidate_count", "blocking_recall")


def with_context(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs with s1_ and candidate_ columns of both records' normalised fields; unknown ids fail when read."""
    return with_record(with_record(pairs, records, ID1, "s1_", CONTEXT, "^S1-"), records, ID2, "candidate_", CONTEXT, "^S[23]-")


def error_rows(scored: DataFrame, threshold: float, kind: str, score: str = "score") -> DataFrame:
    """Rows that are a `model_false_negative` or a `false_positive` at the threshold, marked as such."""
    conditions = {"model_false_negative": (F.col("label") == 1) & (F.col(score) < threshold), "false_positive": (F.col("label") == 0) & (F.col(score) >= threshold)}
    if kind not in conditions:
        raise ValueError(f"unknown error type: {kind}")
    return scored.where(conditions[kind]).withColumns({"error_type": F.lit(kind), "selected_threshold": F.lit(float(threshold))})


def ranked(errors: DataFrame, top: int | None = None, score: str = "score") -> DataFrame:
    """Errors by falling score, then ids; the first `top` of them where given."""
    out = errors.orderBy(F.desc(score), ID1, ID2)
    return out if top is None else out.limit(top)


def near_threshold(errors: DataFrame, threshold: float, window: float = 0.05, score: str = "score") -> DataFrame:
    """Errors whose score lies within `window` of the threshold."""
    return errors.where(F.abs(F.col(score) - threshold) <= window)


def blocked_rows(links: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """True links that no candidate pair has, as error rows without score."""
    lost = blocked_links(links, pairs).withColumnRenamed("matched_entity_id", ID2)
    return lost.withColumns({"candidate_source": F.substring(ID2, 1, 2), "label": F.lit(1), "score": F.lit(None).cast("double"), "error_type": F.lit("blocked_true_link"), "selected_threshold": F.lit(float(threshold))})


def error_summary(errors: DataFrame, score: str = "score") -> DataFrame:
    """(dimension, value, count) of error rows with context in ten dimensions; score bands without rows count 0."""
    s = F.col(score)
    band = F.lit(BANDS[0][1])
    for edge, name in BANDS[1:]:
        band = F.when(s >= edge, name).otherwise(band)
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    values = {
        "error_type": F.col("error_type"), "candidate_source": F.col("candidate_source"), "score_band": band,
        "name_missing_s1": empty("s1_name_norm"), "name_missing_candidate": empty("candidate_name_norm"), "address_missing_s1": empty("s1_address_norm"), "address_missing_candidate": empty("candidate_address_norm"),
        "country_missing_either": empty("s1_country_norm") | empty("candidate_country_norm"), "name_exact": F.col("name_exact"), "address_exact": F.col("address_exact"),
    }
    items = F.array(*[F.struct(F.lit(k).alias("dimension"), v.cast("string").alias("value")) for k, v in values.items()])
    got = errors.select(F.explode(items).alias("x")).groupBy("x.dimension", "x.value").agg(F.count("*").alias("count"))
    bands = errors.sparkSession.createDataFrame([("score_band", n, 0) for _, n in BANDS], "dimension string, value string, count long")
    some = errors.limit(1).select(F.lit(1).alias("k"))  # no errors, no rows
    return got.union(bands.join(some, F.lit(True), "left_semi")).groupBy("dimension", "value").agg(F.sum("count").alias("count"))


def qa_counts(candidates: DataFrame, scored: DataFrame, matches: DataFrame, s1: DataFrame) -> DataFrame:
    """One row: S1 entities, candidates, scored pairs, matches, and S1 entities without candidates and with no, one or more matches."""
    per = lambda df, n: df.groupBy(ID1).agg(F.count("*").alias(n))
    rows = s1.select(as_text(F.col("entity_id")).alias(ID1)).distinct().join(per(candidates, "c"), ID1, "left").join(per(matches, "m"), ID1, "left").join(per(scored, "k"), ID1, "left").fillna(0)
    total = lambda x: F.coalesce(F.sum(x), F.lit(0))
    m = F.col("m")
    return rows.agg(F.count("*").alias("inference_s1_count"), total("c").alias("inference_candidate_count"), F.count_if(F.col("c") == 0).alias("inference_candidate_s1_zero_count"), total("k").alias("matcher_output_count"), total("m").alias("predicted_match_count"), F.count_if(m == 0).alias("predicted_s1_zero_count"), F.count_if(m == 1).alias("predicted_s1_one_count"), F.count_if(m > 1).alias("predicted_s1_multiple_count"))


def paired_differences(per_seed: DataFrame, baseline: str = "baseline", metric: str = "validation_macro_f0_5") -> DataFrame:
    """Improvement of each run over the baseline of its seed; a seed with no baseline, or two, fails."""
    base = per_seed.where(F.col("feature_set") == baseline).groupBy("seed").agg(F.count("*").alias("__n"), F.first(metric).cast("double").alias("baseline_macro_f0_5"))
    rows = per_seed.where(F.col("feature_set") != baseline).select("feature_set", "seed", F.col(metric).cast("double").alias("feature_macro_f0_5")).join(base, "seed", "left")
    wrong = rows.agg(F.count_if(F.col("__n").isNull()).alias("none"), F.count_if(F.col("__n") > 1).alias("two")).first()  # one row
    if wrong.none or wrong.two:
        raise ValueError("no baseline row for a seed" if wrong.none else "the baseline has duplicate rows for a seed")
    return rows.select("feature_set", "seed", "baseline_macro_f0_5", "feature_macro_f0_5", (F.col("feature_macro_f0_5") - F.col("baseline_macro_f0_5")).alias("paired_improvement"))


def paired_summary(differences: DataFrame) -> DataFrame:
    """Per feature set: seeds, mean, sample deviation (0 for one seed), least and most improvement."""
    x = F.col("paired_improvement")
    return differences.groupBy("feature_set").agg(F.count(x).alias("seeds"), F.avg(x).alias("mean"), F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("paired_improvement_std"), F.min(x).alias("min"), F.max(x).alias("max"))


def aggregate_results(per_seed: DataFrame, by=("feature_set",)) -> DataFrame:
    """Per group: runs, and mean, population deviation, least and most of every metric there is."""
    there = [m for m in METRICS if m in per_seed.columns]
    parts = [(F.avg, "mean"), (F.stddev_pop, "std"), (F.min, "min"), (F.max, "max")]
    return per_seed.groupBy(*by).agg(F.count("*").alias("seeds"), *[f(F.col(m).cast("double")).alias(f"{m}_{n}") for m in there for f, n in parts])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
