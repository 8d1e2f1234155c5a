"""Splits and samples by S1 entity, the same for the same seed whatever the partitions."""
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .records import ID1, ID2, as_text
from ..sources.tsv import parse_ids


def draw(c, seed: int):
    """A number from 0 to 1 for each id and seed, by MD5, which other engines can compute too."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), c).cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def split_by_s1(truth: DataFrame, fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, validation): rows of truth by S1 entity; about `fraction` of the entities, one at least, are validation.

    Each id is drawn on its own, so no list of ids is gathered and nothing is sorted.
    """
    if not 0 < fraction < 1:
        raise ValueError("the validation fraction must lie between 0 and 1")
    rows = truth.withColumn("__u", draw(as_text(F.col(ID1)), seed))
    least = rows.agg(F.coalesce(F.min("__u"), F.lit(0.0)).alias("u")).first().u
    chosen = (F.col("__u") < fraction) | (F.col("__u") == least)
    return rows.where(~chosen).drop("__u"), rows.where(chosen).drop("__u")


def split_shuffled(truth: DataFrame, fraction: float = 0.2, seed: int = 42, most: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """As split_by_s1 with an exact share: ids by first appearance are shuffled by numpy's generator on the driver, so there may be at most `most`."""
    if not 0 < fraction < 1:
        raise ValueError("the validation fraction must lie between 0 and 1")
    first = truth.select(as_text(F.col(ID1)).alias("s"), F.monotonically_increasing_id().alias("k")).groupBy("s").agg(F.min("k").alias("k"))
    if first.count() > most:
        raise ValueError(f"over {most} entities: use split_by_s1")
    ids = np.array([r.s for r in first.orderBy("k").collect()], dtype=object)
    np.random.default_rng(seed).shuffle(ids)
    n = max(1, round(len(ids) * fraction)) if len(ids) else 0
    chosen = F.broadcast(truth.sparkSession.createDataFrame([(i,) for i in ids[:n]], "__s string"))  # at most `most` ids
    key = as_text(F.col(ID1)) == F.col("__s")
    return truth.join(chosen, key, "left_anti"), truth.join(chosen, key, "left_semi")


def nested_split(truth: DataFrame, validation: float = 0.2, development: float = 0.25, seed: int = 42, split=split_by_s1) -> dict[str, DataFrame]:
    """train and validation, and model and development within train, with the seed and the next one."""
    train, held = split(truth, validation, seed)
    model, dev = split(train, development, seed + 1)
    return {"train": train, "validation": held, "model": model, "development": dev}


def of_s1(rows: DataFrame, truth: DataFrame, inside: bool = True) -> DataFrame:
    """Rows whose S1 entity is in truth, or is not."""
    ids = truth.select(as_text(F.col(ID1)).alias("__s")).distinct()
    return rows.join(ids, F.col(ID1) == F.col("__s"), "left_semi" if inside else "left_anti")


def sample(records: DataFrame, n: int, seed: int = 42, key: str = "entity_id") -> DataFrame:
    """Exactly n records, or all there are: those of lowest draw; ties by id."""
    return records.withColumn("__u", draw(F.col(key), seed)).orderBy("__u", key).limit(n).drop("__u")


def sample_world(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, n: int = 3000, seed: int = 42) -> dict[str, DataFrame]:
    """n S1 records, their truth rows, and the S2 and S3 records that these name, each sorted by id."""
    mine = sample(s1, n, seed)
    rows = truth.join(mine.select(F.col("entity_id").alias(ID1)), ID1, "left_semi")
    ids = rows.select(F.explode(parse_ids(F.col("matched_entity_ids"))).alias("entity_id")).distinct()
    return {"source1": mine.orderBy("entity_id"), "source2": s2.join(ids, "entity_id", "left_semi").orderBy("entity_id"), "source3": s3.join(ids, "entity_id", "left_semi").orderBy("entity_id"), "ground_truth": rows.orderBy(ID1)}


def blocked_links(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """True links that are no candidate pair."""
    p = pairs.select(ID1, F.col(ID2).alias("matched_entity_id")).distinct()
    return links.join(p, [ID1, "matched_entity_id"], "left_anti")
