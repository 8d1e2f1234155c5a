"""One row per S1 entity, and what such tables must fulfil."""
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tsv import split_ids
from .records import ID1, ID2, as_text, broken, counted, pair_violations, require


def lists_by_s1(pairs: DataFrame, s1_ids: DataFrame, column: str) -> DataFrame:
    """Sorted comma lists of candidates, empty for S1 entities without any."""
    got = pairs.groupBy(ID1).agg(F.array_join(F.array_sort(F.collect_set(ID2)), ",").alias(column))
    return s1_ids.select(ID1).join(got, ID1, "left").fillna("", [column])


def aggregate_candidates(pairs: DataFrame, s1: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """candidate_entity_ids by S1 entity, from pairs that hold; s1 and known are records."""
    require(pair_violations(pairs, s1, known), "candidate pairs")
    return lists_by_s1(pairs, s1.select(as_text(F.col("entity_id")).alias(ID1)), "candidate_entity_ids")


def aggregate_matches(matches: DataFrame, s1: DataFrame, candidates: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """matched_entity_ids by S1 entity, from pairs that hold and are candidates."""
    require(pair_violations(matches, s1, known), "matched pairs")
    if candidates is not None:
        require(outside(matches, candidates), "matched pairs")
    return lists_by_s1(matches, s1.select(as_text(F.col("entity_id")).alias(ID1)), "matched_entity_ids")


def outside(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(kind, n) of matches that are no candidate pair."""
    return broken({"not a candidate": matches.select(ID1, ID2).join(candidates.select(ID1, ID2), [ID1, ID2], "left_anti")})


def _violations(outputs: dict[str, tuple[DataFrame, str]], s1_ids: DataFrame, known: DataFrame) -> DataFrame:
    """(output, kind, n) over tables of lists, (table, column) by label; one aggregation over S1 ids, and one over listed ids.

    Ids of the second table that the first has not are no candidates.
    """
    labels = list(outputs)
    count = lambda k: F.count_if(F.col("t") == k).alias(f"n{k}")
    mine = [df.select(as_text(F.col(ID1)).alias("s"), F.lit(k).alias("t"), split_ids(F.col(c)).alias("ids")) for k, (df, c) in enumerate(outputs.values())]
    rows = reduce(lambda a, b: a.unionByName(b), mine).persist()
    s1 = rows.select("s", "t").union(s1_ids.select(as_text(F.col(ID1)), F.lit(-1))).groupBy("s").agg(*map(count, range(len(labels))), F.max(F.col("t") == -1).alias("wanted"))
    ids = rows.select("s", "t", F.explode("ids").alias("id")).groupBy("s", "id").agg(*map(count, range(len(labels))))
    ids = ids.join(known.select(as_text(F.col("entity_id")).alias("id"), F.lit(1).alias("there")).distinct(), "id", "left")
    if_ = lambda c, n="1": F.when(F.expr(c), F.expr(n))
    of_s1, of_ids = {}, {}
    for k, label in enumerate(labels):
        n, named = f"n{k}", "id rlike '^S[23]-'"
        of_s1 |= {f"{label}|duplicate S1": if_(f"{n} > 1", f"{n} - 1"), f"{label}|missing S1": if_(f"{n} = 0 and wanted"), f"{label}|unknown S1": if_("not wanted", n)}
        of_ids |= {f"{label}|duplicate id": if_(f"{n} > 1", f"{n} - 1"), f"{label}|namespace": if_(f"not {named}", n), f"{label}|unknown id": if_(f"{named} and there is null", n)}
        if k:
            of_ids[f"{label}|not a candidate"] = if_("n0 = 0", n)
    out = counted(s1, of_s1).union(counted(ids, of_ids))
    return out.select(F.split_part("kind", F.lit("|"), F.lit(1)).alias("output"), F.split_part("kind", F.lit("|"), F.lit(2)).alias("kind"), "n")


def violations(output: DataFrame, column: str, s1_ids: DataFrame, known: DataFrame) -> DataFrame:
    """(kind, n) of every rule that a table of lists breaks; no rows when it is valid. Blank ids of a list are ids outside the namespaces."""
    return _violations({"output": (output, column)}, s1_ids, known).drop("output")


def submission_violations(candidates: DataFrame, matches: DataFrame, s1_ids: DataFrame, known: DataFrame) -> DataFrame:
    """(output, kind, n) over both tables of lists, matches that are no candidates among them."""
    outputs = {"candidates": (candidates, "candidate_entity_ids"), "matches": (matches, "matched_entity_ids")}
    for label, (df, column) in outputs.items():
        if df.columns != [ID1, column]:
            raise ValueError(f"columns of {label} must be exactly {ID1}, {column}")
    return _violations(outputs, s1_ids, known)


def submission_counts(candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: S1 entities, candidate pairs, matches, and S1 entities without either."""
    n = lambda c: F.size(split_ids(F.col(c)))
    rows = candidates.join(matches, ID1, "full").select(n("candidate_entity_ids").alias("c"), n("matched_entity_ids").alias("m"))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    return rows.agg(F.count("*").alias("s1_count"), total("c").alias("candidate_pair_count"), total("m").alias("predicted_match_count"), F.count_if(F.col("c") == 0).alias("zero_candidate_s1_count"), F.count_if(F.col("m") == 0).alias("zero_match_s1_count"))


def validate_submission(candidates: DataFrame, matches: DataFrame, s1_ids: DataFrame, known: DataFrame) -> dict[str, int]:
    """Counts of a valid submission; a ValueError names what an invalid one breaks."""
    found = submission_violations(candidates, matches, s1_ids, known)
    require(found.select(F.concat_ws(" ", "output", "kind").alias("kind"), "n"), "submission")
    return submission_counts(candidates, matches).first().asDict()
