"""Candidate pairs by exact keys and shared tokens, without listing all pairs."""
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_RULES = ("country_name_exact", "country_address_exact", "name_token", "address_token", "name_address_token")
EXTRA_RULES = ("name_token_overlap_2", "name_token_overlap_3", "address_token_overlap_2", "address_token_overlap_3")
RULES = DEFAULT_RULES + EXTRA_RULES
#: Every rule is a condition on one row of the pair table.
CONDITIONS = {
    "country_name_exact": "name_exact = 1", "country_address_exact": "address_exact = 1",
    "name_token": "n_name >= 1", "address_token": "n_address >= 1", "name_address_token": "n_name >= 1 and n_address >= 1",
    "name_token_overlap_2": "n_name >= 2", "name_token_overlap_3": "n_name >= 3",
    "address_token_overlap_2": "n_address >= 2", "address_token_overlap_3": "n_address >= 3",
}


@dataclass(frozen=True)
class BlockingConfig:
    name_cap: int = 50
    address_cap: int = 50
    bucket_cap: int = 500
    rules: tuple = DEFAULT_RULES

    def __post_init__(self):
        if min(self.name_cap, self.address_cap, self.bucket_cap) < 1:
            raise ValueError("caps must be at least 1")
        check_rules(self.rules)


def check_rules(rules) -> None:
    unknown = [r for r in rules if r not in CONDITIONS]
    if unknown:
        raise ValueError(f"unknown rules: {', '.join(unknown)}")


def compatible(a, b):
    """Countries agree, or one is missing."""
    return (a == "") | (b == "") | (a == b)


def token_frequency(records: DataFrame, column: str) -> DataFrame:
    """Records that hold each token."""
    return records.select(F.explode(F.array_distinct(column)).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def _caps(cap) -> tuple:
    """(suffix, cap) of one cap, which has no suffix, or of several."""
    return (("", cap),) if isinstance(cap, int) else tuple((f"_{c}", c) for c in cap)


def _shared_tokens(s1, cand, field, cap):
    held = cand.select(F.col("entity_id").alias("c"), F.col("country_norm").alias("cc"), F.explode(F.array_distinct(f"{field}_tokens")).alias("token"))
    rare = token_frequency(cand, f"{field}_tokens").where(F.col("df") <= max(c for _, c in _caps(cap)))
    mine = s1.select(F.col("entity_id").alias("s"), F.col("country_norm").alias("sc"), F.explode(F.array_distinct(f"{field}_tokens")).alias("token"))
    hits = mine.join(held.join(rare, "token"), "token").where(compatible(F.col("sc"), F.col("cc")))
    return hits.select("s", "c", *[(F.col("df") <= c).cast("long").alias(f"n_{field}{x}") for x, c in _caps(cap)])


def _same_key(s1, cand, field, cap):
    key = f"{field}_norm"
    small = cand.where(F.col(key) != "").groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") <= cap).select(key)
    held = cand.join(small, key).select(key, F.col("entity_id").alias("c"), F.col("country_norm").alias("cc"))
    mine = s1.select(key, F.col("entity_id").alias("s"), F.col("country_norm").alias("sc"))
    return mine.join(held, key).where(compatible(F.col("sc"), F.col("cc"))).select("s", "c", F.lit(1).alias(f"{field}_exact"))


def pair_table(s1: DataFrame, cand: DataFrame, config: BlockingConfig = BlockingConfig(), caps: tuple | None = None) -> DataFrame:
    """(s, c, n_name, n_address, name_exact, address_exact) for all pairs that some key or token joins.

    With `caps`, several frequency caps, there is a count for each (n_name_25 and
    so on), so that all configurations of a comparison come from one table.
    """
    names, addresses = (config.name_cap, config.address_cap) if caps is None else (caps, caps)
    parts = [_shared_tokens(s1, cand, "name", names), _shared_tokens(s1, cand, "address", addresses), _same_key(s1, cand, "name", config.bucket_cap), _same_key(s1, cand, "address", config.bucket_cap)]
    facts = [f"n_{f}{x}" for f, cap in (("name", names), ("address", addresses)) for x, _ in _caps(cap)] + ["name_exact", "address_exact"]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.groupBy("s", "c").agg(*[F.coalesce((F.max if f.endswith("_exact") else F.sum)(f), F.lit(0)).cast("long").alias(f) for f in facts])


EXACT, TOKENS = DEFAULT_RULES[:2], DEFAULT_RULES[2:]
#: Configurations of the comparison: caps of name and address tokens, and rules.
CONFIGURATIONS = {
    "default_union": (50, 50, DEFAULT_RULES), "tokens_only": (50, 50, TOKENS), "exact_only": (50, 50, EXACT),
    "no_name_token": (50, 50, (*EXACT, "address_token", "name_address_token")), "no_address_token": (50, 50, (*EXACT, "name_token", "name_address_token")),
    **{f"name_cap_{n}": (n, 50, DEFAULT_RULES) for n in (25, 10)}, **{f"address_cap_{n}": (50, n, DEFAULT_RULES) for n in (25, 10)},
    **{f"name_cap_{n}_address_cap_{a}": (n, a, DEFAULT_RULES) for n, a in ((10, 25), (25, 10), (25, 25))},
    **{f"strict_overlap_{k}": (50, 50, (*EXACT, f"name_token_overlap_{k}", f"address_token_overlap_{k}", "name_address_token")) for k in (2, 3)},
    "address_overlap_2_only": (50, 50, (*EXACT, "name_token", "address_token_overlap_2", "name_address_token")),
    "name_overlap_2_only": (50, 50, (*EXACT, "name_token_overlap_2", "address_token", "name_address_token")),
}
#: Those that are also scored.
SCORED = ("strict_overlap_2", "name_cap_25_address_cap_25", "address_cap_25", "name_cap_25", "default_union")
CAPS = (10, 25, 50)


def condition(rules, name_cap: int | None = None, address_cap: int | None = None) -> str:
    """What a pair fulfils if some of the rules gives it; with caps, on a pair table that has a count for each."""
    check_rules(rules)
    text = " or ".join(f"({CONDITIONS[r]})" for r in rules)
    for field, cap in (("n_name", name_cap), ("n_address", address_cap)):
        text = text.replace(field, f"{field}_{cap}") if cap else text
    return text


def candidates(pairs: DataFrame, rules=None) -> DataFrame:
    """Pairs that some rule gives, with the rules that do; no rules means the default ones."""
    chosen = tuple(rules or DEFAULT_RULES)
    check_rules(chosen)
    found = F.array_compact(F.array(*[F.when(F.expr(CONDITIONS[r]), r) for r in RULES if r in chosen]))
    return pairs.withColumn("rules", found).where(F.size("rules") > 0).select(
        F.col("s").alias("source1_entity_id"), F.col("c").alias("candidate_entity_id"), F.regexp_extract("c", "^(S[123])-", 1).alias("candidate_source"), F.array_join("rules", "|").alias("blocking_rules"))


def rule_contributions(pairs: DataFrame, truth: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """Per rule: pairs, those that no other rule gives, those that one does, true links, and true links that no other rule gives."""
    t = truth.select(F.col("source1_entity_id").alias("s"), F.col("matched_entity_id").alias("c"), F.lit(1).alias("t")).distinct()
    n = reduce(lambda a, b: a + b, [F.expr(f"int({CONDITIONS[r]})") for r in rules])
    rows = pairs.join(t, ["s", "c"], "left").withColumn("n", n).select("n", "t", F.explode(F.array_compact(F.array(*[F.when(F.expr(CONDITIONS[r]), r) for r in rules]))).alias("rule"))
    got = rows.groupBy("rule").agg(F.count("*").alias("pairs"), F.count_if(F.col("n") == 1).alias("unique_pairs"), F.count_if(F.col("n") > 1).alias("overlap_pairs"), F.count("t").alias("true_links"), F.count_if((F.col("n") == 1) & F.col("t").isNotNull()).alias("unique_true_links"))
    return pairs.sparkSession.createDataFrame([(r,) for r in rules], "rule string").join(got, "rule", "left").fillna(0)


def pareto(report: DataFrame) -> DataFrame:
    """Configurations that no other beats in candidates, p95, p99 and recall; the report is a few rows."""
    a, b = report.alias("a"), report.alias("b")
    no_worse = F.expr("b.candidates <= a.candidates and b.p95 <= a.p95 and b.p99 <= a.p99 and b.recall >= a.recall")
    better = F.expr("b.candidates < a.candidates or b.p95 < a.p95 or b.p99 < a.p99 or b.recall > a.recall")
    return a.join(b, no_worse & better, "left_anti").orderBy("candidates", "p95", "p99", F.desc("recall"))
