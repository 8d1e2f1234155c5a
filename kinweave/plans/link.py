"""From raw records to matches."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import char_ngrams, preprocess
from ..operators import blocking, errors, evaluate, features, records, submission
from ..operators.models import THRESHOLD, BoostedScorer, scores
from ..operators.records import ID1
from ..sources.tsv import RAW, encode_lists, read_tree, read_tsv, write_summary, write_tsv

SOURCES = ("source1", "source2", "source3")


def split_sources(rows: DataFrame):
    return rows.where("source = 'S1'"), rows.where("source in ('S2', 'S3')")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the input comes in fewer splits; large inputs have enough and stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def prepared(raw: DataFrame, ngram_size: int = 3) -> DataFrame:
    """Normalised records, kept without n-grams: the Python part of normalisation runs once, whatever reads them."""
    narrow = preprocess(spread(raw), ngrams=False).drop("name_char_ngrams", "address_char_ngrams").persist()
    return narrow.withColumns({f"{f}_char_ngrams": char_ngrams(F.col(f"{f}_norm"), ngram_size) for f in ("name", "address")})


def preprocess_file(spark, source: str, target: str, ngram_size: int = 3, ngrams: bool = True) -> None:
    """Normalise a TSV of raw records into one with JSON lists."""
    write_tsv(encode_lists(preprocess(read_tsv(spark, source), ngram_size, ngrams)), target)


def preprocess_tree(spark, root: str, target: str, splits=("train", "test"), ngram_size: int = 3) -> None:
    """Normalise the three sources of each split; the ground truth beside them is no source."""
    for split in splits:
        for name, df in read_tree(spark, f"{root}/{split}", [f"{split}_{s}" for s in SOURCES]).items():
            write_tsv(encode_lists(preprocess(df, ngram_size)), f"{target}/{split}/{name}.tsv")


def build_candidates(s1: DataFrame, others: DataFrame, config=blocking.BlockingConfig()) -> DataFrame:
    """Candidate pairs, checked: ids unique and in their sources, pairs distinct and in their namespaces."""
    records.require(records.record_violations(s1, others.where("source = 'S2'"), others.where("source = 'S3'")), "records")
    pairs = blocking.candidates(blocking.pair_table(s1, others, config), config.rules).persist()
    records.require(records.pair_violations(pairs), "candidate pairs")
    return pairs


def featured(rows: DataFrame, config=blocking.BlockingConfig(), names=features.BASELINE, fitted_on: DataFrame | None = None):
    """(S1 records, candidate pairs, features) of normalised records."""
    s1, cand = split_sources(rows)
    pairs = build_candidates(s1, cand, config)
    return s1, pairs, features.pair_features(pairs, s1, cand, names)


def run_pipeline(train: DataFrame, truth: DataFrame, rows: DataFrame, scorer=None, threshold: float = THRESHOLD, config=blocking.BlockingConfig(), names=features.BASELINE) -> dict:
    """Scored pairs, matches, lists by S1 entity and counts, from normalised records and truth lists.

    The scorer learns from candidate pairs of train. Records that both sides have
    must be alike. The result's tables are lazy, but for the scored pairs, which are kept.
    """
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must be in [0, 1]")
    records.require(records.truth_violations(truth), "ground truth")
    clash = records.conflicts(train, rows).limit(1).collect()
    if clash:
        raise ValueError(f"conflicting records for id: {clash[0].entity_id}")
    _, train_pairs, made = featured(train, config, names)
    labelled = features.with_labels(made, evaluate.truth_links(truth)).persist()
    model = (scorer or BoostedScorer()).fit(labelled, names)
    s1, pairs, made = featured(rows, config, names)
    made = made.persist()
    records.require(records.feature_violations(made, names, pairs), "features")
    scored = scores(model, made).persist()
    records.require(records.score_violations(scored), "scores")
    matches = scored.where(F.col("match_probability") >= threshold)
    ids = s1.select(F.col("entity_id").alias(ID1))
    counts = errors.qa_counts(pairs, scored, matches, s1).first().asDict()
    counts |= {"training_candidate_count": train_pairs.count(), "training_feature_rows": labelled.count(), "training_feature_columns": len(names), "threshold": threshold}
    labelled.unpersist()
    made.unpersist()
    return {"model": model, "candidates": pairs, "scored": scored, "matches": matches, "counts": counts, "candidate_lists": submission.lists_by_s1(pairs, ids, "candidate_entity_ids"), "match_lists": submission.lists_by_s1(matches, ids, "matched_entity_ids")}


def link(train: DataFrame, truth: DataFrame, raw: DataFrame, scorer=None, threshold: float = THRESHOLD, config=blocking.BlockingConfig(), names=features.BASELINE):
    """Scored candidate pairs and one list per S1 entity of raw records; the scorer learns from train and truth links."""
    lists = truth.groupBy(ID1).agg(F.array_join(F.array_sort(F.collect_set("matched_entity_id")), ",").alias("matched_entity_ids"))
    out = run_pipeline(prepared(train), lists, prepared(raw), scorer, threshold, config, names)
    return out["scored"], out["match_lists"]


def run_submission(spark, root: str, output: str, scorer=None, threshold: float = THRESHOLD, names=features.BASELINE, ngram_size: int = 3, evaluation: DataFrame | None = None, thresholds=None) -> dict:
    """From a folder with train and test TSVs to checked output lists; the counts, and scores against `evaluation` truth where given."""
    def raw(split):
        got = read_tree(spark, f"{root}/{split}", [f"{split}_{s}" for s in SOURCES], RAW)
        return [got[f"{split}_{s}"] for s in SOURCES]

    def joined(frames):
        return prepared(frames[0].unionByName(frames[1]).unionByName(frames[2]), ngram_size)

    test = raw("test")
    truth = read_tsv(spark, f"{root}/train/train_ground_truth.tsv", (ID1, "matched_entity_ids"), label="ground truth")
    out = run_pipeline(joined(raw("train")), truth, joined(test), scorer, threshold, names=names)
    ids, known = test[0].select(F.col("entity_id").alias(ID1)), test[1].select("entity_id").union(test[2].select("entity_id"))
    counts = out["counts"] | submission.validate_submission(out["candidate_lists"], out["match_lists"], ids, known)
    write_tsv(out["candidate_lists"].orderBy(ID1), f"{output}/candidates.tsv", 1)
    write_tsv(out["match_lists"].orderBy(ID1), f"{output}/matches.tsv", 1)
    write_tsv(out["scored"], f"{output}/scored.tsv")
    others = known.count()
    counts |= {"validation_status": "passed", "cartesian_pair_count": counts["s1_count"] * others, "candidate_reduction_ratio": evaluate.reduction_ratio(counts["candidate_pair_count"], counts["s1_count"], others)}
    if evaluation is not None:
        wanted = [threshold, *(thresholds or ())]
        got = {round(r.threshold, 12): r.macro_f05 for r in evaluate.threshold_report(out["scored"], evaluate.truth_links(evaluation), evaluation, wanted).collect()}
        counts |= {"macro_f0_5": got[round(threshold, 12)], "threshold_scores": {t: got[round(t, 12)] for t in thresholds or ()}}
    write_summary(spark, counts, f"{output}/summary.json")
    return counts


def write_candidates(pairs: DataFrame, path: str, metadata: bool = False) -> None:
    """Candidate pairs as TSV, checked and sorted; with metadata, their source and rules too."""
    records.require(records.pair_violations(pairs), "candidate pairs")
    more = ("candidate_source", "blocking_rules") if metadata else ()
    write_tsv(pairs.select(ID1, records.ID2, *more).orderBy(ID1, records.ID2), path)


def read_processed(spark, path: str) -> DataFrame:
    """Normalised records from a TSV with JSON lists."""
    return records.prepare_records(read_tsv(spark, path, records.PROCESSED, label="processed records"))


