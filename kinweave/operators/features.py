"""Features of candidate pairs."""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions.normalize import char_ngrams, tokenize
from .records import ID1, ID2, as_text, failing

_PER_FIELD = ("exact", "ratio", "token_set_ratio", "token_sort_ratio", "jaccard", "overlap", "char_ngram_jaccard", "tfidf_cosine")
BASELINE = tuple(f"{f}_{x}" for f in ("name", "address") for x in _PER_FIELD) + ("country_exact", "country_nonempty_both", "name_length_ratio", "address_length_ratio")
GROUPS = {
    "name": ("name_partial_ratio", "name_token_containment_s1", "name_token_containment_candidate"),
    "address": ("address_partial_ratio", "address_token_containment_s1", "address_token_containment_candidate", "address_numeric_jaccard", "address_numeric_overlap"),
    "country": ("country_missing_either", "country_both_missing"),
    "cross_field": ("name_address_ratio_product", "name_address_tfidf_product", "name_address_ratio_min", "name_address_both_high"),
}


ABLATION_SETS = ("baseline", "baseline_plus_name", "baseline_plus_address", "baseline_plus_country", "baseline_plus_cross_field", "baseline_plus_name_address_cross")
ROBUSTNESS_SETS = ("baseline", "baseline_plus_address", "baseline_plus_cross_field", "baseline_plus_address_cross_field", "baseline_plus_name_address_cross")


def unique_ordered(names) -> tuple[str, ...]:
    """Names in their order; none or repeated ones are an error."""
    out = tuple(str(n) for n in names)
    if not out:
        raise ValueError("a feature set cannot be empty")
    if len(set(out)) < len(out):
        raise ValueError("a feature set has duplicate names")
    return out


def feature_set(spec, available=None) -> tuple[str, ...]:
    """Feature names of `all`, `baseline`, a group, `baseline_plus_` and groups joined by `_`, or an explicit list; `cross` is short for cross_field."""
    known = BASELINE + tuple(x for g in GROUPS.values() for x in g)
    available = known if available is None else tuple(available)
    if not isinstance(spec, str):
        names = unique_ordered(spec)
    elif spec in ("all", "baseline") or spec in GROUPS:
        names = {"all": available, "baseline": BASELINE, **GROUPS}[spec]
    elif spec.startswith("baseline_plus_"):
        groups = spec.removeprefix("baseline_plus_").replace("cross_field", "cross").split("_")
        groups = ["cross_field" if g == "cross" else g for g in groups]
        if any(g not in GROUPS for g in groups):
            raise ValueError(f"unknown feature groups in {spec}")
        names = BASELINE + tuple(x for g in groups for x in GROUPS[g])
    else:
        raise ValueError(f"unknown feature set: {spec}")
    names = unique_ordered(names)
    if set(names) - set(available):
        raise ValueError(f"unknown feature names: {sorted(set(names) - set(available))}")
    return names


def chosen_sets(names: str | None = None, robustness: bool = False) -> dict[str, tuple[str, ...]]:
    """Feature sets of a comma-separated list, else those of the robustness or the ablation run."""
    if names:
        picked = [n.strip() for n in names.split(",") if n.strip()]
        if not picked:
            raise ValueError("name at least one feature set")
    else:
        picked = ROBUSTNESS_SETS if robustness else ABLATION_SETS
    return {n: feature_set(n) for n in picked}


def gram_frequency(records: DataFrame, column: str, low: int = 3, high: int = 5) -> DataFrame:
    """(gram, df): for the hash of each character gram, the records that hold it."""
    def count(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4000):
                h, _, _ = sim.counted(*sim.grams(b.column(0).slice(at, 4000).fill_null("").to_pylist(), low, high))
                h, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "df"])

    return records.select(column).mapInArrow(count, "gram long, df long").groupBy("gram").agg(F.sum("df").alias("df"))


def fitted_idf(records: DataFrame, column: str, low: int = 3, high: int = 5):
    """A broadcast sim.Idf of all records: 16 bytes for each gram that two of them hold, nothing for the others."""
    shared = gram_frequency(records, column, low, high).where("df > 1").toArrow()
    h, df = (shared[c].to_numpy() for c in ("gram", "df"))
    return records.sparkSession.sparkContext.broadcast(sim.Idf(records.count(), h.view(np.uint64), df, low, high))


def with_record(pairs: DataFrame, records: DataFrame, key: str, prefix: str, columns, namespace: str) -> DataFrame:
    """Pairs with columns of the record that key names, under prefix; ids that are unknown or outside the namespace fail when rows are read."""
    mine = records.select(F.col("entity_id").alias("__id"), *[F.col(c).alias(prefix + c) for c in columns])
    out = pairs.join(mine, F.col(key) == F.col("__id"), "left")
    bad = F.when(~F.col(key).rlike(namespace), F.concat(F.lit("id outside its namespace: "), key)).when(F.col("__id").isNull(), F.concat(F.lit("unknown id: "), key))
    return out.withColumn(key, failing(bad, F.col(key))).drop("__id")


def pair_features(pairs: DataFrame, s1: DataFrame, cand: DataFrame, names=BASELINE) -> DataFrame:
    """Ids, sources and the features `names`, in their order, of pairs (source1_entity_id, candidate_entity_id).

    Repeated pairs give repeated rows, no pairs give none. Pairs with an id that
    no record has, or that is outside S1, or S2 and S3, fail. TF-IDF is fitted on
    all records given; where none has three characters, the ratio stands in for its cosine.
    """
    names, need = tuple(names), set(names)
    for product, parts in {"name_address_ratio_product": "ratio", "name_address_ratio_min": "ratio", "name_address_both_high": "ratio", "name_address_tfidf_product": "tfidf_cosine"}.items():
        if product in need:
            need |= {f"name_{parts}", f"address_{parts}"}
    sides, plain, idf = {"a_": s1, "b_": cand}, {f: [] for f in ("name", "address")}, {}
    columns = [c for f in ("name", "address") for c in (f"{f}_norm", f"{f}_tokens", f"{f}_char_ngrams")] + ["country_norm"]
    for f in plain:
        if f"{f}_tfidf_cosine" in need:
            records = s1.select("entity_id", f"{f}_norm").unionByName(cand.select("entity_id", f"{f}_norm"))
            if records.where(F.length(f"{f}_norm") >= 3).isEmpty():
                plain[f].append("tfidf_cosine")
                continue
            idf[f] = fitted_idf(records, f"{f}_norm")
            columns.append(f"{f}_norm_length")
            sides = {k: r.withColumn(f"{f}_norm_length", sim.tfidf_norm(F.col(f"{f}_norm"), idf[f])) for k, r in sides.items()}
    # lists that follow from the text are not carried: where both sides of a pair have such lists, the sets are compared by the texts
    derived = {f"{f}_{x}": (f"{f}_norm", make) for f in plain for x, make in (("tokens", tokenize), ("char_ngrams", char_ngrams))}
    same = {c: F.col(text).isNotNull() & F.col(c).eqNullSafe(make(F.col(text))) for c, (text, make) in derived.items()}
    sides = {k: r.withColumns({f"{c}_same": v for c, v in same.items()} | {c: F.when(~v, F.col(c)) for c, v in same.items()}) for k, r in sides.items()}
    columns += [f"{c}_same" for c in derived]
    out = pairs.select(as_text(F.col(ID1)).alias(ID1), as_text(F.col(ID2)).alias(ID2))
    out = with_record(with_record(out, sides["a_"], ID1, "a_", columns, "^S1-"), sides["b_"], ID2, "b_", columns, "^S[23]-")
    by_text = {c: F.col(f"a_{c}_same") & F.col(f"b_{c}_same") for c in derived}
    out = out.withColumns({k + c: F.when(by_text[c], None).when(F.col(f"{k}{c}_same"), make(F.col(k + text))).otherwise(F.col(k + c)) for k in sides for c, (text, make) in derived.items()})
    made = {}
    for f in plain:
        a, b, x, y, g, h = (F.col(f"{k}_{f}_{c}") for c in ("norm", "tokens", "char_ngrams") for k in "ab")
        made |= {f"{f}_exact": sim.exact(a, b), f"{f}_length_ratio": sim.length_ratio(a, b)}
        by_list = {"jaccard": sim.jaccard(x, y), "overlap": sim.overlap(x, y), "char_ngram_jaccard": sim.jaccard(g, h), "token_containment_s1": sim.containment(x, y), "token_containment_candidate": sim.containment(y, x), "numeric_jaccard": sim.jaccard(sim.numeric_tokens(x), sim.numeric_tokens(y)), "numeric_overlap": sim.overlap(sim.numeric_tokens(x), sim.numeric_tokens(y))}
        wanted = tuple(r for r in sim.COMPARED if f"{f}_{r}" in need or r == "ratio" and plain[f])
        if wanted:
            out = out.withColumn(f"__{f}", sim.ratios(a, b, wanted))
            made |= {f"{f}_{r}": F.col(f"__{f}")[r] for r in wanted}
            made |= {f"{f}_{r}": F.when(by_text[f"{f}_char_ngrams" if r == "char_ngram_jaccard" else f"{f}_tokens"], made[f"{f}_{r}"]).otherwise(c) for r, c in by_list.items() if r in wanted}
        made[f"{f}_tfidf_cosine"] = F.col(f"__{f}")["ratio"] if plain[f] else sim.tfidf_cosine(a, F.col(f"a_{f}_norm_length"), b, F.col(f"b_{f}_norm_length"), idf[f]) if f"{f}_tfidf_cosine" in need else F.lit(None)
    a, b = F.col("a_country_norm"), F.col("b_country_norm")
    made |= {"country_exact": sim.exact(a, b), "country_nonempty_both": ((a != "") & (b != "")).cast("double"), "country_missing_either": ((a == "") | (b == "")).cast("double"), "country_both_missing": ((a == "") & (b == "")).cast("double")}
    out = out.withColumns({k: v for k, v in made.items() if k in need})
    if need & set(GROUPS["cross_field"]):
        of = lambda x: (F.col(f"name_{x}"), F.col(f"address_{x}"))
        x, y = of("ratio")
        u, v = of("tfidf_cosine")
        cross = {"name_address_ratio_product": x * y, "name_address_tfidf_product": u * v, "name_address_ratio_min": F.least(x, y), "name_address_both_high": ((x >= 0.8) & (y >= 0.8)).cast("double")}
        out = out.withColumns({k: c for k, c in cross.items() if k in need})
    source = lambda c: F.regexp_extract(c, "^(S[123])-", 1)
    return out.select(ID1, ID2, source(ID1).alias("source1_source"), source(ID2).alias("candidate_source"), *names)


def with_labels(features: DataFrame, truth: DataFrame) -> DataFrame:
    """label 1 where (source1_entity_id, matched_entity_id) is in truth."""
    t = truth.select("source1_entity_id", F.col("matched_entity_id").alias("candidate_entity_id"), F.lit(1).alias("label")).distinct()
    return features.join(t, ["source1_entity_id", "candidate_entity_id"], "left").fillna(0, ["label"])
