"""Comparisons of blocking configurations, feature sets and seeds, and audits of one model."""
import json
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocking, errors, evaluate, features, models, splits
from ..operators.records import ID1
from ..sources.tsv import write_reports, write_summary

SEEDS = (42, 123, 2024, 3407, 7777)


def blocking_report(s1: DataFrame, cand: DataFrame, links: DataFrame, bucket_cap: int = 500, configurations=None) -> DataFrame:
    """A row for each configuration, all from one pair table that counts shared tokens under every cap."""
    chosen = configurations or blocking.CONFIGURATIONS
    caps = tuple(sorted({c for n, a, _ in chosen.values() for c in (n, a)}))
    pairs = blocking.pair_table(s1, cand, blocking.BlockingConfig(bucket_cap=bucket_cap), caps)
    found = evaluate.report(pairs, {k: blocking.condition(r, n, a) for k, (n, a, r) in chosen.items()}, links, s1.select(F.col("entity_id").alias(ID1)))
    return evaluate.configuration_rows(found, {k: "|".join(r) for k, (_, _, r) in chosen.items()})


def rules_report(s1: DataFrame, cand: DataFrame, links: DataFrame, rules=blocking.DEFAULT_RULES) -> DataFrame:
    """Each rule alone and the union of all, evaluated alike."""
    sets = {r: blocking.condition((r,)) for r in rules} | {"union_default": blocking.condition(rules)}
    return evaluate.report(blocking.pair_table(s1, cand), sets, links, s1.select(F.col("entity_id").alias(ID1)))


def contributions(s1: DataFrame, cand: DataFrame, links: DataFrame, rules=blocking.DEFAULT_RULES) -> DataFrame:
    """What each rule adds, beside its own evaluation."""
    pairs = blocking.pair_table(s1, cand)
    sets = {r: blocking.condition((r,)) for r in rules}
    alone = evaluate.report(pairs, sets, links, s1.select(F.col("entity_id").alias(ID1))).withColumnRenamed("configuration", "rule")
    return blocking.rule_contributions(pairs, links, rules).join(alone, "rule")


def evaluate_blocking(s1: DataFrame, cand: DataFrame, links: DataFrame) -> dict[str, DataFrame]:
    """Candidate counts by population, contributions of rules, all configurations, and those that no other beats."""
    ids = s1.select(F.col("entity_id").alias(ID1))
    per = evaluate.candidates_by_s1(blocking.candidates(blocking.pair_table(s1, cand)), links, ids)
    report = blocking_report(s1, cand, links).persist()
    return {"populations": evaluate.population_distributions(per), "contributions": contributions(s1, cand, links), "configurations": report, "frontier": blocking.pareto(report)}


def parts_of(truth: DataFrame, validation: float, development: float, seed: int) -> dict[str, DataFrame]:
    """The four parts of the nested split, each kept with its links."""
    return {k: v.persist() for k, v in splits.nested_split(truth, validation, development, seed).items()}


def train_and_choose(made: DataFrame, parts: dict[str, DataFrame], names, factory, seed: int, label: str):
    """(threshold, model, scored validation rows, reports): the threshold comes from development rows alone, the model from all training rows."""
    def stage(model, part):
        rows = model.predict(splits.of_s1(made, parts[part])).withColumn("score", F.col("match_probability")).persist()
        found = evaluate.threshold_report(rows, evaluate.truth_links(parts[part]), parts[part])
        return rows, found.select(F.lit(label).alias("configuration"), F.lit(part).alias("stage"), "*")

    first = models.make(factory, seed).fit(splits.of_s1(made, parts["model"]), names)
    scored, dev = stage(first, "development")
    dev = dev.persist()
    threshold = evaluate.best_threshold(dev).first().threshold
    final = models.make(factory, seed).fit(splits.of_s1(made, parts["train"]), names)
    held, val = stage(final, "validation")
    return threshold, final, held, dev.unionByName(val)


def summary(metrics: dict, held: DataFrame, reports: DataFrame, truth: DataFrame, threshold: float, names, started: float) -> dict:
    """The numbers of one run: candidates, recall, threshold, links and time."""
    links = evaluate.link_counts(held, evaluate.truth_links(truth), threshold).first().asDict()
    at = {r.stage: r for r in reports.where(F.abs(F.col("threshold") - threshold) < 1e-9).collect()}  # a row a stage
    n, hit = metrics["candidate_count"], metrics["true_matches_retrieved"]
    return {
        "candidates": n, "avg_s1": metrics["mean"], "median_s1": metrics["median"], "p95_s1": metrics["p95"], "p99_s1": metrics["p99"], "max_s1": metrics["max"], "s1_over_100_candidates": metrics["gt_100"],
        "positive_candidate_pairs": hit, "negative_candidate_pairs": n - hit, "blocking_recall": metrics["blocking_recall"], "s2_blocking_recall": metrics["s2_recall"], "s3_blocking_recall": metrics["s3_recall"],
        "blocking_missed_links": metrics["true_match_count"] - hit, "feature_rows": n, "feature_columns": len(names), "feature_shape": f"({n}, {len(names)})", "threshold": threshold,
        "development_precision": at["development"].precision, "development_recall": at["development"].recall, "development_macro_f0_5": at["development"].macro_f05,
        "precision": links["link_precision"], "recall": links["link_recall"], "macro_f0_5": at["validation"].macro_f05, "predicted_links": links["predicted_links"], "true_positive_links": links["true_positive_links"],
        "false_positive_links": links["false_positive_links"], "model_fn_among_candidates": links["model_fn_among_candidates"], "blocked_out_validation_links": links["candidate_loss_links"], "false_negative_links": links["false_negative_links"],
        "validation_true_links": links["true_positive_links"] + links["false_negative_links"], "validation_candidate_true_links": links["candidate_true_links"], "runtime_seconds": time.perf_counter() - started,
    }


def run_experiment(s1: DataFrame, cand: DataFrame, truth: DataFrame, names=features.BASELINE, configurations=blocking.SCORED, factory=models.LogisticScorer, seed: int = 42, validation: float = 0.2, development: float = 0.25) -> tuple[list[dict], DataFrame]:
    """(summaries, threshold reports): every configuration is blocked, featured, learned and judged on the same split."""
    links, ids = evaluate.truth_links(truth), s1.select(F.col("entity_id").alias(ID1))
    parts, rows, reports = parts_of(truth, validation, development, seed), [], []
    for label in configurations:
        started = time.perf_counter()
        n, a, rules = blocking.CONFIGURATIONS[label]
        pairs = blocking.candidates(blocking.pair_table(s1, cand, blocking.BlockingConfig(n, a)), rules).persist()
        metrics = evaluate.evaluate_candidates(pairs, links, ids).first().asDict()
        made = features.with_labels(features.pair_features(pairs, s1, cand, names), links).persist()
        if made.count() != metrics["candidate_count"]:
            raise RuntimeError("there must be one feature row for each candidate pair")
        threshold, _, held, found = train_and_choose(made, parts, names, factory, seed, label)
        rows.append({"configuration": label} | summary(metrics, held, found, parts["validation"], threshold, names, started))
        reports.append(found)
    return rows, errors.union_all(reports)


def run_ablation(s1: DataFrame, cand: DataFrame, truth: DataFrame, sets=None, seeds=(42,), factory=models.LogisticScorer, validation: float = 0.2, development: float = 0.25) -> dict:
    """Every feature set under every seed on one feature table; per-seed rows, their aggregate, threshold reports and scored validation rows by (seed, set)."""
    if not seeds:
        raise ValueError("give at least one seed")
    spark, sets = s1.sparkSession, sets or features.chosen_sets()
    links, ids = evaluate.truth_links(truth), s1.select(F.col("entity_id").alias(ID1))
    pairs = blocking.candidates(blocking.pair_table(s1, cand)).persist()
    metrics = evaluate.evaluate_candidates(pairs, links, ids).first().asDict()
    everything = features.unique_ordered(dict.fromkeys(n for names in sets.values() for n in names))
    made = features.with_labels(features.pair_features(pairs, s1, cand, everything), links).persist()
    rows, reports, scored = [], [], {}
    for seed in seeds:
        parts = parts_of(truth, validation, development, seed)
        for label, names in sets.items():
            started = time.perf_counter()
            threshold, _, held, found = train_and_choose(made, parts, names, factory, seed, label)
            one = summary(metrics, held, found, parts["validation"], threshold, names, started)
            renamed = {"candidate_count": one["candidates"], "validation_precision": one["precision"], "validation_recall": one["recall"], "validation_macro_f0_5": one["macro_f0_5"]}
            kept = ("blocking_recall", "s2_blocking_recall", "s3_blocking_recall", "threshold", "development_precision", "development_recall", "development_macro_f0_5", "predicted_links", "true_positive_links", "false_positive_links", "false_negative_links", "model_fn_among_candidates", "blocked_out_validation_links", "validation_candidate_true_links", "runtime_seconds")
            rows.append({"feature_set": label, "feature_names": json.dumps(list(names)), "feature_count": len(names), "seed": seed, "outer_seed": seed, "development_seed": seed + 1, "selection_uses_validation_labels": False} | renamed | {k: one[k] for k in kept})
            reports.append(found.withColumns({"seed": F.lit(seed), "development_seed": F.lit(seed + 1)}))
            scored[seed, label] = (held, parts["validation"], threshold)
    per_seed = spark.createDataFrame([tuple(r.values()) for r in rows], list(rows[0]))
    return {"per_seed": per_seed, "aggregate": errors.aggregate_results(per_seed), "reports": errors.union_all(reports), "scored": scored, "pairs": pairs, "metrics": metrics}


def run_robustness(s1: DataFrame, cand: DataFrame, truth: DataFrame, seeds=SEEDS, **more) -> dict:
    """The ablation over several seeds, with paired improvements over the baseline."""
    out = run_ablation(s1, cand, truth, features.chosen_sets(robustness=True), seeds, **more)
    paired = errors.paired_differences(out["per_seed"])
    return out | {"paired": paired, "paired_summary": errors.paired_summary(paired)}


def error_artifact(out: dict, records: DataFrame, label: str = "baseline_plus_address", seed: int | None = None) -> DataFrame:
    """False positives, false negatives and blocked links of one run of an ablation, with both records' fields."""
    seed = next(iter(out["scored"]))[0] if seed is None else seed
    if (seed, label) not in out["scored"]:
        raise ValueError(f"no run of seed {seed} and feature set {label}")
    held, truth, threshold = out["scored"][seed, label]
    parts = [errors.with_context(errors.error_rows(held, threshold, kind), records) for kind in ("false_positive", "model_false_negative")]
    lost = errors.blocked_rows(evaluate.truth_links(truth), out["pairs"], threshold)
    return errors.union_all([*parts, errors.with_context(lost, records)]).withColumns({"feature_set": F.lit(label), "seed": F.lit(seed)})


def run_audit(s1: DataFrame, cand: DataFrame, truth: DataFrame, folder: str | None = None, names=features.BASELINE, factory=models.LogisticScorer, seed: int = 42, validation: float = 0.2, development: float = 0.25, top: int = 25, window: float = 0.05) -> tuple[dict[str, DataFrame], dict]:
    """(tables, summary) of one model: features, coefficients, thresholds and errors; written to folder where given."""
    links, parts = evaluate.truth_links(truth), parts_of(truth, validation, development, seed)
    pairs = blocking.candidates(blocking.pair_table(s1, cand)).persist()
    made = features.with_labels(features.pair_features(pairs, s1, cand, names), links).persist()
    threshold, model, held, reports = train_and_choose(made, parts, names, factory, seed, "default_union")
    dev = splits.of_s1(made, parts["development"]).persist()
    scored = errors.with_context(held, s1.unionByName(cand, allowMissingColumns=True)).persist()
    missed, wrong = (errors.error_rows(scored, threshold, k).persist() for k in ("model_false_negative", "false_positive"))
    near = errors.near_threshold(wrong, threshold, window)
    tables = {
        "feature_diagnostics": evaluate.diagnose(dev, names), "feature_correlations": evaluate.correlations(dev, names), "model_coefficients": models.coefficients(model, names),
        "threshold_development": reports.where("stage = 'development'"), "threshold_validation": reports.where("stage = 'validation'"),
        "validation_model_false_negatives": errors.ranked(missed), "validation_false_positives_high_confidence": errors.ranked(wrong, top), "validation_false_positives_near_threshold": errors.ranked(near),
        "validation_error_summary": errors.error_summary(missed.unionByName(wrong)),
    }
    at = {r["stage"]: r for r in (x.asDict() for x in reports.where(F.abs(F.col("threshold") - threshold) < 1e-9).collect())}  # a row a stage
    false_positives = wrong.count()
    out = {"candidate_count": pairs.count(), "feature_count": len(names), "feature_names": list(names), "development_threshold": threshold, "development_selected_row": at["development"], "validation_selected_row": at["validation"], "validation_model_false_negatives": missed.count(), "validation_false_positives": false_positives, "validation_high_confidence_false_positives_emitted": min(top, false_positives), "validation_near_threshold_false_positives": near.count(), "selection_uses_validation_labels": False, "validation_link_counts": evaluate.link_counts(held, evaluate.truth_links(parts["validation"]), threshold).first().asDict()}
    if folder:
        write_reports(tables, folder)
        write_summary(s1.sparkSession, out, f"{folder}/audit_summary.json")
    return tables, out


