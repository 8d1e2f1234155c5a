"""Checks of records, pairs, features and scores; a check is a table of broken rules, and `require` turns it into an error."""
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tsv import decode_list, require_columns

ID1, ID2 = "source1_entity_id", "candidate_entity_id"
PROCESSED = ("entity_id", "name_norm", "address_norm", "country_norm", "name_tokens", "address_tokens", "name_char_ngrams", "address_char_ngrams")
LISTS = PROCESSED[4:]


def as_text(c):
    """Trimmed text, empty where missing."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def failing(message, value):
    """value where message is null; else reading the row fails with message."""
    return F.when(message.isNotNull(), F.raise_error(message)).otherwise(value)


def numeric(c, strict: bool = False):
    """A text column as double: what is no number is null, or fails where strict."""
    c = c.cast("string")
    return c.cast("double") if strict else c.try_cast("double")


def broken(checks: dict[str, DataFrame]) -> DataFrame:
    """(kind, n) for each check that finds rows; no rows when all hold."""
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, df in checks.items()]
    return reduce(lambda a, b: a.unionByName(b), rows).where("n > 0")


def require(found: DataFrame, label: str) -> None:
    """Raise a ValueError that names the broken rules."""
    rows = sorted(tuple(r) for r in found.select("kind", "n").collect())  # one row a rule
    if rows:
        raise ValueError(f"{label}: " + ", ".join(f"{kind} ({n})" for kind, n in rows))


def twice(df: DataFrame, *keys: str) -> DataFrame:
    """One row for each row beyond the first of its key."""
    return df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").select(*keys, F.explode(F.sequence(F.lit(2), "__n")).alias("__n"))


def prepare_records(records: DataFrame, lists=LISTS) -> DataFrame:
    """Processed records as read from text: fields trimmed, JSON lists decoded, the source taken from the id; an empty id fails when read."""
    require_columns(records, [c for c in PROCESSED if c not in LISTS or c in lists], "processed records")
    kinds = dict(records.dtypes)
    id_ = as_text(F.col("entity_id"))
    out = records.withColumns({c: as_text(F.col(c)) for c in ("name_norm", "address_norm", "country_norm")} | {c: decode_list(F.col(c)) for c in lists if kinds[c] == "string"})
    out = out.withColumn("entity_id", failing(F.when(id_ == "", F.lit("processed records have an empty entity_id")), id_))
    source = F.regexp_extract("entity_id", "^(S[123])-", 1)
    return out.withColumn("source", F.when(as_text(F.col("source")) != "", as_text(F.col("source"))).otherwise(source) if "source" in records.columns else source)


def counted(rows: DataFrame, kinds: dict) -> DataFrame:
    """(kind, n) of sums over rows, from one aggregation; none where a sum is 0."""
    n = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(k) for k, c in kinds.items()])
    return n.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"`{k}`").alias("n")) for k in kinds])).alias("x")).select("x.kind", "x.n").where("n > 0")


def record_violations(s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """(kind, n): empty ids, ids that repeat in a source or between sources, and records of another source than their table's."""
    rows = reduce(lambda a, b: a.unionByName(b), [df.select(as_text(F.col("entity_id")).alias("id"), F.lit(k).alias("t")) for k, df in (("S1", s1), ("S2", s2), ("S3", s3))])
    n, there = F.col("n"), F.col("id") != ""
    per = rows.groupBy("id", "t").agg(F.count("*").alias("n"))
    per = per.groupBy("id").agg(F.sum("n").alias("n"), F.sum(n - 1).alias("more"), F.count("*").alias("sources"), F.sum(F.when(F.regexp_extract("id", "^(S[123])-", 1) != F.col("t"), n)).alias("wrong"))
    return counted(per, {"empty id": F.when(~there, n), "duplicate id": F.when(there, F.col("more")), "id in two sources": F.when(there & (F.col("sources") > 1), 1), "wrong source": F.when(there, F.col("wrong"))})


def pair_violations(pairs: DataFrame, s1_ids: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """(kind, n): empty ids, ids outside their namespace, repeated pairs, and ids not among entity_id of s1_ids and known, where given; the pairs are read once."""
    require_columns(pairs, (ID1, ID2), "pairs")
    rows = pairs.groupBy(as_text(F.col(ID1)).alias("s"), as_text(F.col(ID2)).alias("c")).agg(F.count("*").alias("n"))
    if_ = lambda c, n="n": F.when(F.expr(c), F.expr(n))
    kinds = {
        "empty id": if_("s = '' or c = ''"), "S1 namespace": if_("s <> '' and not s like 'S1-%'"),
        "candidate namespace": if_("c <> '' and not c rlike '^S[23]-'"), "duplicate pair": if_("n > 1", "n - 1"),
    }
    for kind, ids, key in (("unknown S1", s1_ids, "s"), ("unknown candidate", known, "c")):
        if ids is not None:
            rows = rows.join(ids.select(as_text(F.col("entity_id")).alias(key), F.lit(1).alias("in_" + key)).distinct(), key, "left")
            kinds[kind] = if_(f"in_{key} is null")
    return counted(rows, kinds)


def truth_violations(truth: DataFrame) -> DataFrame:
    """(kind, n): missing S1 ids and ids outside S1."""
    require_columns(truth, (ID1, "matched_entity_ids"), "ground truth")
    t = truth.select(as_text(F.col(ID1)).alias("s"))
    return broken({"empty id": t.where("s = ''"), "S1 namespace": t.where("s <> '' and not s like 'S1-%'")})


def feature_violations(features: DataFrame, names, pairs: DataFrame) -> DataFrame:
    """(kind, n): feature rows without their pair, pairs without features (as often as they stand), and values that are null, NaN or infinite."""
    require_columns(features, (ID1, ID2, *names), "features")
    mine, theirs = features.select(ID1, ID2), pairs.select(ID1, ID2)
    bad = reduce(lambda a, b: a | b, [F.col(n).isNull() | F.isnan(n) | (F.abs(n) == float("inf")) for n in names])
    return broken({"row without pair": mine.exceptAll(theirs), "pair without row": theirs.exceptAll(mine), "value not finite": features.where(bad)})


def score_violations(scored: DataFrame, column: str = "match_probability") -> DataFrame:
    """(kind, n): scores that are null, NaN or outside 0 to 1."""
    c = F.col(column)
    return broken({"score outside 0 to 1": scored.where(c.isNull() | F.isnan(c) | ~c.between(0, 1))})


def combine_records(*frames: DataFrame) -> DataFrame:
    """All records once; equal repeats are one, and an id with unlike records fails when read."""
    rows = reduce(lambda a, b: a.unionByName(b), frames)
    rest = [c for c in rows.columns if c != "entity_id"]
    compared = [c for c in rest if c in PROCESSED or c == "source"]
    one = rows.withColumn("__r", F.struct(*compared)).groupBy("entity_id").agg(F.min("__r").alias("__low"), F.max("__r").alias("__high"), F.first(F.struct(*rest)).alias("__x"))
    unlike = F.when(F.col("__low") != F.col("__high"), F.concat(F.lit("conflicting records for id: "), "entity_id"))
    return one.select(failing(unlike, F.col("entity_id")).alias("entity_id"), "__x.*").select(*rows.columns)


def conflicts(*frames: DataFrame) -> DataFrame:
    """Ids that have unlike records."""
    rows = reduce(lambda a, b: a.unionByName(b), frames)
    compared = [c for c in rows.columns if c in PROCESSED[1:] or c == "source"]
    return rows.groupBy("entity_id").agg(F.count_distinct(F.struct(*compared)).alias("kinds")).where("kinds > 1")
