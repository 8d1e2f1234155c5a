"""Command line: python -m kinweave.plans.cli COMMAND. Exit code 1 and a message on wrong input."""
import argparse
import resource
import sys
import zipfile
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, features, models, records, splits, submission
from ..sources.tsv import RAW, read_tree, read_tsv, write_reports, write_summary
from . import experiments, link

TRUTH = (records.ID1, "matched_entity_ids")
SCORERS = {"boosted": models.BoostedScorer, "logistic": models.LogisticScorer}


def rss_mb() -> float:
    """Peak memory of the driver's Python process."""
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kinweave", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(name, *paths, **options):
        p = sub.add_parser(name)
        for x in paths:
            p.add_argument(x)
        for k, v in options.items():
            p.add_argument("--" + k.replace("_", "-"), **(v if isinstance(v, dict) else {"default": v, "type": type(v)}))

    seeds = {"default": "42"}
    split = {"validation_fraction": 0.2, "development_fraction": 0.25}
    command("preprocess", "input", "output", ngram_size={"type": int, "default": 3, "choices": (2, 3, 4, 5)})
    command("candidates", "processed", "output", include_metadata={"action": "store_true"}, name_cap=50, address_cap=50, bucket_cap=500)
    command("submission", "data", "output", threshold=models.THRESHOLD, scorer={"choices": sorted(SCORERS), "default": "boosted"}, evaluation={"default": None})
    command("blocking", "processed", "truth", "output")
    command("experiment", "processed", "truth", "output", seed=42, **split)
    command("ablation", "processed", "truth", "output", seeds=seeds, feature_sets={"default": None}, robustness={"action": "store_true"}, **split)
    command("audit", "processed", "truth", "output", seed=42, top_errors=25, near_threshold_window=0.05, **split)
    command("sample", "data", "output", n=3000, seed=42)
    command("validate", "candidates", "matches", "data")
    command("archive", "output", "folders")
    return top


def archive(target: str, folders: list[str]) -> None:
    """A zip of local folders; a missing one is an error."""
    for f in folders:
        if not Path(f).exists():
            raise FileNotFoundError(f"missing from the archive: {f}")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in folders:
            for p in sorted(x for x in Path(f).rglob("*") if x.is_file() and "__pycache__" not in x.parts):
                z.write(p, p.relative_to(Path(f).parent))


def run(a: argparse.Namespace, spark: SparkSession) -> None:
    def processed():
        frames = read_tree(spark, a.processed, [f"train_{s}" for s in link.SOURCES], records.PROCESSED)
        s1, s2, s3 = (records.prepare_records(frames[f"train_{s}"]) for s in link.SOURCES)
        return s1.persist(), s2.unionByName(s3).persist()

    def truth():
        return read_tsv(spark, a.truth, TRUTH, label="ground truth")

    if a.command == "preprocess":
        link.preprocess_file(spark, a.input, a.output, a.ngram_size)
    elif a.command == "candidates":
        link.write_candidates(link.build_candidates(*processed(), blocking.BlockingConfig(a.name_cap, a.address_cap, a.bucket_cap)), a.output, a.include_metadata)
    elif a.command == "submission":
        against = read_tsv(spark, a.evaluation, TRUTH, label="evaluation ground truth") if a.evaluation else None
        print(link.run_submission(spark, a.data, a.output, SCORERS[a.scorer](), a.threshold, evaluation=against))
    elif a.command == "blocking":
        from ..operators.evaluate import truth_links

        write_reports(experiments.evaluate_blocking(*processed(), truth_links(truth())), a.output)
    elif a.command == "experiment":
        rows, reports = experiments.run_experiment(*processed(), truth(), seed=a.seed, validation=a.validation_fraction, development=a.development_fraction)
        write_reports({"thresholds": reports}, a.output)
        write_summary(spark, {"configurations": rows, "peak_rss_mb": rss_mb()}, f"{a.output}/summary.json")
    elif a.command == "ablation":
        seeds = experiments.SEEDS if a.robustness and a.seeds == "42" else [int(x) for x in a.seeds.split(",") if x.strip()]
        out = experiments.run_ablation(*processed(), truth(), features.chosen_sets(a.feature_sets, a.robustness), seeds, validation=a.validation_fraction, development=a.development_fraction)
        write_reports({k: out[k] for k in ("per_seed", "aggregate", "reports")}, a.output)
    elif a.command == "audit":
        experiments.run_audit(*processed(), truth(), a.output, seed=a.seed, validation=a.validation_fraction, development=a.development_fraction, top=a.top_errors, window=a.near_threshold_window)
    elif a.command == "sample":
        frames = read_tree(spark, a.data, [f"train_{s}" for s in link.SOURCES], RAW)
        rows = read_tsv(spark, f"{a.data}/train_ground_truth.tsv", TRUTH, label="ground truth")
        world = splits.sample_world(*[frames[f"train_{s}"] for s in link.SOURCES], rows, a.n, a.seed)
        write_reports({f"train_{k}": v for k, v in world.items()}, a.output)
    elif a.command == "validate":
        frames = read_tree(spark, a.data, [f"test_{s}" for s in link.SOURCES], RAW)
        s1, s2, s3 = (frames[f"test_{s}"].select("entity_id") for s in link.SOURCES)
        got = [read_tsv(spark, p, (records.ID1, c), label="output") for p, c in ((a.candidates, "candidate_entity_ids"), (a.matches, "matched_entity_ids"))]
        print(submission.validate_submission(*got, s1.select(F.col("entity_id").alias(records.ID1)), s2.union(s3)))
    else:
        archive(a.output, a.folders.split(","))


def main(argv=None) -> int:
    a = parser().parse_args(argv)
    spark = None if a.command == "archive" else SparkSession.builder.appName("kinweave").getOrCreate()
    try:
        run(a, spark)
    except (ValueError, FileNotFoundError, PySparkException) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
