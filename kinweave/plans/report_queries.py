"""Queries of reports, checks, splits, errors and comparisons, each with SQL that gives the same rows."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.normalize import char_ngrams
from ..operators import blocking, errors, evaluate, features, models, records, splits, submission
from ..operators.records import ID1, ID2
from ..sources import tsv
from . import experiments, link
from .queries import _FOUR, BASE, SCORED, _dist, _grams, _jac, _ovl, _pairs, _ratio, default_pairs, links, query, rounded, scored, truth_lists, universe
from .queries import records as all_records

# ---- evaluation of candidates

_T = "t as materialized (select distinct s, c from links)"


def _report(sets, pairs=None):
    """SQL of evaluate.report for named conditions on the pair table p."""
    named = " union all ".join(f"select '{k}' as configuration, s, c from p where {v}" for k, v in sets.items())
    names = ", ".join(f"('{k}')" for k in sets)
    share = lambda a, b: f"round(coalesce(sum({a}) / nullif(sum({b}), 0), 0), 6)"
    of = " ".join(f", coalesce(sum(l{k}), 0)::bigint as s{k}_true_match_count, sum(h{k})::bigint as s{k}_true_matches_retrieved, {share(f'h{k}', f'l{k}')} as s{k}_recall" for k in (2, 3))
    return f"""{pairs or _pairs()}, {_T}, named as ({named}),
per as (select configuration, named.s, count(*) as n, count(t.c) as h, count(t.c) filter (t.c like 'S2-%') as h2, count(t.c) filter (t.c like 'S3-%') as h3 from named left join t on t.s = named.s and t.c = named.c group by all),
tl as (select s, count(*) as l, count(*) filter (c like 'S2-%') as l2, count(*) filter (c like 'S3-%') as l3 from t group by s),
x as (select g.configuration, u.id, coalesce(n, 0) as n, coalesce(h, 0) as h, coalesce(h2, 0) as h2, coalesce(h3, 0) as h3, coalesce(l, 0) as l, coalesce(l2, 0) as l2, coalesce(l3, 0) as l3
  from (values {names}) g(configuration) cross join (select id from r where src = 'S1') u left join per on per.configuration = g.configuration and per.s = u.id left join tl on tl.s = u.id),
rep as (select configuration, sum(n)::bigint as candidate_count, sum(l)::bigint as true_match_count, sum(h)::bigint as true_matches_retrieved, {share('h', 'l')} as blocking_recall {of},
  {_dist('n')}, {_dist('n', 'l > 0', 'matched_')}, {_dist('n', 'l = 0', 'zero_match_')} from x group by configuration)"""


_DEFAULT_ONE = {"all": blocking.condition(blocking.DEFAULT_RULES)}


@query(f"{_report(_DEFAULT_ONE)} select * exclude configuration from rep")
def evaluate_candidates(spark, sf_dir):
    r, s1, c = all_records(spark, sf_dir)
    return rounded(evaluate.evaluate_candidates(default_pairs(s1, c), links(r), universe(s1)))


_ALONE = {x: blocking.condition((x,)) for x in blocking.DEFAULT_RULES}


@query(f"{_report(_ALONE | {'union_default': blocking.condition(blocking.DEFAULT_RULES)})} select * from rep")
def rules_report(spark, sf_dir):
    r, s1, c = all_records(spark, sf_dir)
    return rounded(experiments.rules_report(s1, c, links(r)))


_N = " + ".join(f"({x})::int" for x in _ALONE.values())
_ADDED = " union all ".join(f"select '{k}' as rule, count(*) as pairs, count(*) filter (k = 1) as unique_pairs, count(*) filter (k > 1) as overlap_pairs, count(*) filter (t) as true_links, count(*) filter (t and k = 1) as unique_true_links from f where {v}" for k, v in _ALONE.items())


@query(f"{_report(_ALONE)}, f as (select p.*, {_N} as k, t.s is not null as t from p left join t using (s, c)), ad as ({_ADDED}) select ad.*, rep.* exclude configuration from ad join rep on rep.configuration = ad.rule")
def contributions_report(spark, sf_dir):
    r, s1, c = all_records(spark, sf_dir)
    return rounded(experiments.contributions(s1, c, links(r)))


def _wide():
    """SQL of the pair table with a count for every cap."""
    def tokens(col, name):
        counts = ", ".join(f"count(*) filter (df <= {x}) as n_{name}_{x}" for x in blocking.CAPS)
        return f"""t_{name} as materialized (select id, src, country, unnest(list_distinct({col})) as tok from r),
df_{name} as (select tok, count(*) as df from t_{name} where src <> 'S1' group by tok having count(*) <= {max(blocking.CAPS)}),
h_{name} as (select a.id as s, b.id as c, {counts} from t_{name} a join t_{name} b using (tok) join df_{name} using (tok)
  where a.src = 'S1' and b.src <> 'S1' and (a.country = '' or b.country = '' or a.country = b.country) group by all),
e_{name} as (select a.id as s, b.id as c, 1 as {name}_exact from r a join r b using ({name})
  where a.src = 'S1' and b.src <> 'S1' and {name} <> '' and (a.country = '' or b.country = '' or a.country = b.country)
  and {name} in (select {name} from r where src <> 'S1' group by {name} having count(*) <= 500))"""

    counts = ", ".join(f"coalesce(n_{f}_{x}, 0) as n_{f}_{x}" for f in ("name", "address") for x in blocking.CAPS)
    return f"""{BASE}, {tokens('nt', 'name')}, {tokens('adt', 'address')},
p as materialized (select s, c, {counts}, coalesce(name_exact, 0) as name_exact, coalesce(address_exact, 0) as address_exact
  from h_name full join h_address using (s, c) full join e_name using (s, c) full join e_address using (s, c))"""


_SETS = {k: blocking.condition(rules, n, a) for k, (n, a, rules) in blocking.CONFIGURATIONS.items()}
_RULES = ", ".join(f"('{k}', '{'|'.join(rules)}')" for k, (_, _, rules) in blocking.CONFIGURATIONS.items())
_CONFIGURED = f"""{_report(_SETS, _wide())}, conf as (select configuration, rules, candidate_count as candidates, mean, median, p90, p95, p99, max, blocking_recall as recall, s2_recall, s3_recall, true_match_count - true_matches_retrieved as missed_true_links
  from rep join (values {_RULES}) v(configuration, rules) using (configuration))"""


@query(f"{_CONFIGURED} select * from conf")
def blocking_configurations(spark, sf_dir):
    r, s1, c = all_records(spark, sf_dir)
    return rounded(experiments.blocking_report(s1, c, links(r)))


@query(f"""{_CONFIGURED} select * from conf a where not exists (select 1 from conf b where b.candidates <= a.candidates and b.p95 <= a.p95 and b.p99 <= a.p99 and b.recall >= a.recall
  and (b.candidates < a.candidates or b.p95 < a.p95 or b.p99 < a.p99 or b.recall > a.recall))""")
def blocking_frontier(spark, sf_dir):
    r, s1, c = all_records(spark, sf_dir)
    return blocking.pareto(rounded(experiments.blocking_report(s1, c, links(r))))


@query(f"""{SCORED}, x as (select id, count(k.c) as n, id in (select s from links) as m from r left join k on k.s = id where src = 'S1' group by id)
select 'all_s1' as population, {_dist('n')} from x union all select 's1_with_truth', {_dist('n', 'm')} from x union all select 's1_without_truth', {_dist('n', 'not m')} from x""")
def population_distributions(spark, sf_dir):
    r, s1, c = all_records(spark, sf_dir)
    return rounded(evaluate.population_distributions(evaluate.candidates_by_s1(default_pairs(s1, c), links(r), universe(s1))))


@query(f"{SCORED} select count(*) as pairs, round(1 - count(*) / ((select count(*) from r where src = 'S1') * (select count(*) from r where src <> 'S1')), 9) as reduction_ratio from k")
def reduction_ratio(spark, sf_dir):
    _, s1, c = all_records(spark, sf_dir)
    n = default_pairs(s1, c).count()
    return spark.createDataFrame([(n, round(evaluate.reduction_ratio(n, s1.count(), c.count()), 9))], "pairs long, reduction_ratio double")


# ---- truth, predictions and link counts

_LISTS = "tl as (select id as s, coalesce(string_agg(l.c, ',' order by l.c), '') as ids from r left join links l on l.s = id where src = 'S1' group by id)"


@query(f"{BASE}, {_LISTS} select count(distinct s) as s1_entities, count(*) as ground_truth_rows, count(*) filter (ids = '') as empty_truth_entities, (select count(*) from links) as positive_links, (select count(*) from links where c like 'S2-%') as s2_links, (select count(*) from links where c like 'S3-%') as s3_links from tl")
def truth_summary(spark, sf_dir):
    return evaluate.truth_summary(truth_lists(all_records(spark, sf_dir)[0]))


@query(f"{BASE} select s as source1_entity_id, c as candidate_entity_id, 1 as label from links union all select s, c, 1 from links where s like '%7'")
def truth_pairs(spark, sf_dir):
    t = truth_lists(all_records(spark, sf_dir)[0])
    return evaluate.truth_pairs(t.union(t.where(f"{ID1} like '%7'")))


@query(f"""{SCORED} select count(*) filter (t and k) as candidate_true_links, count(*) filter (t and not k) as candidate_loss_links, count(*) filter (t and m >= 0.5) as true_positive_links, count(*) filter (not t and m >= 0.5) as false_positive_links,
  count(*) filter (t and m < 0.5) as model_fn_among_candidates, count(*) filter (t and coalesce(m, 0) < 0.5) as false_negative_links, count(*) filter (m >= 0.5) as predicted_links,
  round(coalesce(count(*) filter (t and m >= 0.5) / nullif(count(*) filter (m >= 0.5), 0), 0), 6) as link_precision, round(coalesce(count(*) filter (t and m >= 0.5) / nullif(count(*) filter (t), 0), 0), 6) as link_recall
  from (select m, m is not null as k, l.s is not null as t from sc full join links l on l.s = sc.s and l.c = sc.c)""")
def link_counts(spark, sf_dir):
    r, _, sc = scored(spark, sf_dir)
    return rounded(evaluate.link_counts(sc, links(r), 0.5))


@query(f"{SCORED} select u.s as source1_entity_id, coalesce(string_agg(sc.c, '|' order by sc.c), '') as candidates from (select s from sc union select s from links) u left join sc on sc.s = u.s and m >= 0.5 group by u.s")
def predictions(spark, sf_dir):
    r, _, sc = scored(spark, sf_dir)
    return evaluate.predictions(sc, 0.5, links(r)).withColumn("candidates", F.array_join("candidates", "|"))


# ---- splits and samples


def _draw(x, seed):
    return f"('0x' || substr(md5('{seed}:' || {x}), 1, 8))::bigint / 4294967296.0"


def _part(rows, fraction, seed):
    u = _draw("id", seed)
    return f"(select id from {rows} where {u} < {fraction} or {u} = (select min({u}) from {rows}))"


@query(f"{BASE}, u as (select id from r where src = 'S1'), v as {_part('u', 0.2, 42)}, tr as (select id from u where id not in (select id from v)), dv as {_part('tr', 0.25, 43)} select id as source1_entity_id, case when id in (select id from v) then 'validation' when id in (select id from dv) then 'development' else 'model' end as part from u")
def nested_split(spark, sf_dir):
    parts = splits.nested_split(truth_lists(all_records(spark, sf_dir)[0]))
    return errors.union_all([parts[k].select(ID1, F.lit(k).alias("part")) for k in ("validation", "development", "model")])


@query(f"{SCORED}, u as (select id from r where src = 'S1'), v as {_part('u', 0.2, 42)} select s as source1_entity_id, c as candidate_entity_id, s in (select id from v) as held_out from k")
def split_pairs(spark, sf_dir):
    r, s1, c = all_records(spark, sf_dir)
    pairs, (_, held) = default_pairs(s1, c).select(ID1, ID2), splits.split_by_s1(truth_lists(r))
    return splits.of_s1(pairs, held).withColumn("held_out", F.lit(True)).union(splits.of_s1(pairs, held, False).withColumn("held_out", F.lit(False)))


@query(f"""{BASE}, m as (select id from r where src = 'S1' order by {_draw('id', 42)}, id limit 30), n as (select c as id from links where s in (select id from m))
select id as entity_id, 'source1' as part from m union all select id, 'source' || src[2:] from r where src <> 'S1' and id in (select id from n) union all select id, 'ground_truth' from m""")
def sample_world(spark, sf_dir):
    r, s1, c = all_records(spark, sf_dir)
    world = splits.sample_world(s1, c.where("source = 'S2'"), c.where("source = 'S3'"), truth_lists(r), 30)
    return errors.union_all([v.select(F.col(ID1 if k == "ground_truth" else "entity_id").alias("entity_id"), F.lit(k).alias("part")) for k, v in world.items()])


@query(f"{SCORED} select l.s as source1_entity_id, l.c as matched_entity_id from links l where not exists (select 1 from k where k.s = l.s and k.c = l.c)")
def blocked_links(spark, sf_dir):
    r, s1, c = all_records(spark, sf_dir)
    return splits.blocked_links(links(r), default_pairs(s1, c))


# ---- errors

_EXACT = "(a.name <> '' and a.name = b.name)::double as name_exact, (a.address <> '' and a.address = b.address)::double as address_exact"
_ERRORS = f"""{SCORED}, er as materialized (select sc.s, sc.c, m, (l.s is not null)::int as label, case when l.s is not null then 'model_false_negative' else 'false_positive' end as error_type,
  a.name as an, a.address as aa, a.country as ac, b.name as bn, b.address as ba, b.country as bc, b.src as source, {_EXACT}
  from sc join r a on a.id = sc.s join r b on b.id = sc.c left join links l on l.s = sc.s and l.c = sc.c where (l.s is not null and m < 0.5) or (l.s is null and m >= 0.5))"""
_ERROR_COLUMNS = "s as source1_entity_id, c as candidate_entity_id, error_type, round(m, 9) as score, an as s1_name_norm, aa as s1_address_norm, ac as s1_country_norm, bn as candidate_name_norm, ba as candidate_address_norm, bc as candidate_country_norm"


def _errors(spark, sf_dir):
    r, s1, c = all_records(spark, sf_dir)
    names = ("name_jaccard", "address_jaccard", "name_exact", "address_exact")
    f = features.with_labels(features.pair_features(default_pairs(s1, c), s1, c, names), links(r))
    f = errors.with_context(f.withColumn("score", F.greatest("name_jaccard", "address_jaccard")), r)
    return errors.error_rows(f, 0.5, "model_false_negative").unionByName(errors.error_rows(f, 0.5, "false_positive"))


def _shown(df):
    return rounded(df.select(ID1, ID2, "error_type", "score", *[f"{k}_{x}" for k in ("s1", "candidate") for x in errors.CONTEXT]), 9)


@query(f"{_ERRORS} select {_ERROR_COLUMNS} from er")
def error_rows(spark, sf_dir):
    return _shown(_errors(spark, sf_dir))


@query(f"{_ERRORS} select {_ERROR_COLUMNS} from er where error_type = 'false_positive' order by m desc, s, c limit 25")
def top_errors(spark, sf_dir):
    return _shown(errors.ranked(_errors(spark, sf_dir).where("error_type = 'false_positive'"), 25))


@query(f"{_ERRORS} select {_ERROR_COLUMNS} from er where abs(m - 0.5) <= 0.05")
def near_threshold(spark, sf_dir):
    return _shown(errors.near_threshold(_errors(spark, sf_dir), 0.5))


_BANDS = ", ".join(f"('{n}')" for _, n in errors.BANDS)
_BAND = "case when m >= 0.95 then '>=0.95' when m >= 0.9 then '0.90-0.95' when m >= 0.75 then '0.75-0.90' when m >= 0.5 then '0.50-0.75' when m >= 0.25 then '0.25-0.50' else '<0.25' end"
_DIMENSIONS = {"error_type": "error_type", "candidate_source": "source", "name_missing_s1": "an = ''", "name_missing_candidate": "bn = ''", "address_missing_s1": "aa = ''", "address_missing_candidate": "ba = ''", "country_missing_either": "ac = '' or bc = ''", "name_exact": "name_exact", "address_exact": "address_exact"}


@query(f"{_ERRORS} " + " union all ".join(f"select '{k}' as dimension, ({v})::varchar as value, count(*) as count from er group by all" for k, v in _DIMENSIONS.items()) + f" union all select 'score_band', b, count(er.s) from (values {_BANDS}) v(b) left join er on {_BAND} = b group by b")
def error_summary(spark, sf_dir):
    return errors.error_summary(_errors(spark, sf_dir))


@query(f"""{SCORED}, u as (select id, (select count(*) from k where k.s = id) as c, (select count(*) from sc where sc.s = id and m >= 0.5) as m from r where src = 'S1')
select count(*) as inference_s1_count, sum(c)::bigint as inference_candidate_count, count(*) filter (c = 0) as inference_candidate_s1_zero_count, sum(c)::bigint as matcher_output_count, sum(m)::bigint as predicted_match_count, count(*) filter (m = 0) as predicted_s1_zero_count, count(*) filter (m = 1) as predicted_s1_one_count, count(*) filter (m > 1) as predicted_s1_multiple_count from u""")
def qa_counts(spark, sf_dir):
    _, s1, sc = scored(spark, sf_dir)
    return errors.qa_counts(sc, sc, sc.where("match_probability >= 0.5"), s1)


# ---- the pipeline with a scorer that SQL can follow


def _run(spark, sf_dir):
    r, _, _ = all_records(spark, sf_dir)
    return link.run_pipeline(r, truth_lists(r), r, models.BestOf(), 0.5, names=("name_jaccard", "address_jaccard"))


@query(f"""{SCORED} select id as source1_entity_id, coalesce((select string_agg(k.c, ',' order by k.c) from k where k.s = id), '') as candidate_entity_ids, coalesce((select string_agg(sc.c, ',' order by sc.c) from sc where sc.s = id and m >= 0.5), '') as matched_entity_ids from r where src = 'S1'""")
def run_pipeline(spark, sf_dir):
    out = _run(spark, sf_dir)
    return out["candidate_lists"].join(out["match_lists"], ID1)


@query(f"""{SCORED}, u as (select id, (select count(*) from k where k.s = id) as c, (select count(*) from sc where sc.s = id and m >= 0.5) as m from r where src = 'S1')
select count(*) as s1_count, sum(c)::bigint as candidate_pair_count, sum(m)::bigint as predicted_match_count, count(*) filter (c = 0) as zero_candidate_s1_count, count(*) filter (m = 0) as zero_match_s1_count from u""")
def submission_counts(spark, sf_dir):
    out = _run(spark, sf_dir)
    return submission.submission_counts(out["candidate_lists"], out["match_lists"])


# ---- checks, on tables that break them on purpose


@query(f"""{BASE}, x as (select id, src as t from r union all select id, 'S1' from r where src = 'S1' and id like '%5' union all select id, 'S3' from r where src = 'S2' and id like '%4' union all select '', 'S2' from r where id like '%9')
select * from (select 'empty id' as kind, count(*) as n from x where id = '' union all select 'duplicate id', sum(k - 1)::bigint from (select count(*) as k from x where id <> '' group by id, t having count(*) > 1)
  union all select 'id in two sources', count(*) from (select id from x where id <> '' group by id having count(distinct t) > 1) union all select 'wrong source', count(*) from x where id <> '' and id[1:2] <> t) where n > 0""")
def record_violations(spark, sf_dir):
    r, s1, c = all_records(spark, sf_dir)
    ids, s2, s3 = s1.select("entity_id"), c.where("source = 'S2'").select("entity_id"), c.where("source = 'S3'").select("entity_id")
    return records.record_violations(ids.union(ids.where("entity_id like '%5'")), s2.union(r.where("entity_id like '%9'").select(F.lit(" ").alias("entity_id"))), s3.union(s2.where("entity_id like '%4'")))


@query(f"""{SCORED}, x as (select s, c from k union all select s, c from k where c like '%3' union all select c, s from k where s like '%1' union all select s, '' from k where c like '%7'), u as (select id from r where id not like '%2')
select * from (select 'empty id' as kind, count(*) as n from x where s = '' or c = '' union all select 'S1 namespace', count(*) from x where s <> '' and s not like 'S1-%' union all select 'candidate namespace', count(*) from x where c <> '' and c not like 'S2-%' and c not like 'S3-%'
  union all select 'duplicate pair', sum(k - 1)::bigint from (select count(*) as k from x group by s, c having count(*) > 1) union all select 'unknown S1', count(*) from x where s not in (select id from u where id like 'S1-%') union all select 'unknown candidate', count(*) from x where c not in (select id from u where id not like 'S1-%')) where n > 0""")
def pair_violations(spark, sf_dir):
    _, s1, c = all_records(spark, sf_dir)
    p = default_pairs(s1, c).select(ID1, ID2)
    bad = p.union(p.where(f"{ID2} like '%3'")).union(p.where(f"{ID1} like '%1'").select(ID2, ID1)).union(p.where(f"{ID2} like '%7'").select(ID1, F.lit(None).cast("string")))
    return records.pair_violations(bad, s1.where("entity_id not like '%2'"), c.where("entity_id not like '%2'"))


@query(f"{BASE} select * from (select 'empty id' as kind, count(*) as n from r where src = 'S1' and id like '%1' union all select 'S1 namespace', count(*) from r where src = 'S2') where n > 0")
def truth_violations(spark, sf_dir):
    r, s1, _ = all_records(spark, sf_dir)
    rows = s1.selectExpr(f"if(entity_id like '%1', '  ', entity_id) as {ID1}").union(r.where("source = 'S2'").select("entity_id"))
    return records.truth_violations(rows.withColumn("matched_entity_ids", F.lit("")))


@query(f"{BASE} select id as entity_id, 2::bigint as kinds from r where id like '%8' and name <> ''")
def record_conflicts(spark, sf_dir):
    r = all_records(spark, sf_dir)[0].select(*records.PROCESSED, "source")
    return records.conflicts(r, r.withColumn("name_norm", F.when(F.col("entity_id").like("%8"), "").otherwise(F.col("name_norm"))))


@query(f"{BASE} select id as entity_id, name as name_norm from r")
def combined_records(spark, sf_dir):
    r = all_records(spark, sf_dir)[0].select(*records.PROCESSED, "source")
    return records.combine_records(r, r.where("source <> 'S3'"), r).select("entity_id", "name_norm")


@query(f"""{SCORED}, u as (select count(*) filter (s not like '%1') as kept, count(*) filter (s like '%1') as gone, count(*) filter (c like '%3' and s not like '%1') as more, (select count(*) from sc where s not like '%1' and m = 0.5) as nan, (select count(*) from sc where s not like '%1' and c like '%3' and m = 0.5) as nan2 from k)
select * from (select 'row without pair' as kind, more as n from u union all select 'pair without row', gone from u union all select 'value not finite', nan + nan2 from u) where n > 0""")
def feature_violations(spark, sf_dir):
    _, s1, c = all_records(spark, sf_dir)
    p = default_pairs(s1, c)
    f = features.pair_features(p, s1, c, ("name_jaccard", "address_jaccard"))
    f = f.where(f"{ID1} not like '%1'").withColumn("name_jaccard", F.when(F.greatest("name_jaccard", "address_jaccard") == 0.5, float("nan")).otherwise(F.col("name_jaccard")))
    return records.feature_violations(f.union(f.where(f"{ID2} like '%3'")), ("name_jaccard", "address_jaccard"), p)


@query(f"{SCORED} select * from (select 'score outside 0 to 1' as kind, count(*) as n from sc where m > 0.5 or s like '%4') where n > 0")
def score_violations(spark, sf_dir):
    _, _, sc = scored(spark, sf_dir)
    m = F.col("match_probability")
    return records.score_violations(sc.withColumn("match_probability", F.when(F.col(ID1).like("%4"), None).otherwise(F.when(m > 0.5, m + 1).otherwise(m))))


_BROKEN = """cl as (select s, c from k where s not like '%1' union all select s, c from k where s like '%3'), ml as (select s, c from k where s not like '%1' union all select s, s from k where s like '%5')"""


@query(f"""{SCORED}, {_BROKEN}, u as (select id from r where src = 'S1'), cs as (select id from u where id not like '%1' union all select id from u where id like '%2'), ms as (select id from u)
select * from (select 'candidates' as output, 'duplicate S1' as kind, count(*) as n from u where id like '%2' union all select 'candidates', 'missing S1', count(*) from u where id like '%1' union all select 'candidates', 'duplicate id', (select count(*) from k where s like '%3') + (select count(*) from k where s like '%2')
  union all select 'candidates', 'unknown id', count(*) from (select s, c from cl union all select s, c from k where s like '%2') where c like '%9' union all select 'matches', 'namespace', count(*) from ml where c like 'S1-%' union all select 'matches', 'duplicate id', coalesce(sum(n - 1), 0)::bigint from (select count(*) as n from ml group by s, c having count(*) > 1)
  union all select 'matches', 'unknown id', count(*) from ml where c like '%9' and c not like 'S1-%' union all select 'matches', 'not a candidate', count(*) from ml where c like 'S1-%') where n > 0""")
def submission_violations(spark, sf_dir):
    _, s1, c = all_records(spark, sf_dir)
    p, ids = default_pairs(s1, c).select(ID1, ID2).persist(), universe(s1)

    def lists(rows, column):
        got = rows.groupBy(ID1).agg(F.array_join(F.array_sort(F.collect_list(ID2)), ",").alias(column))
        return ids.join(got, ID1, "left").fillna("", [column])

    candidates = lists(p.union(p.where(f"{ID1} like '%3'")), "candidate_entity_ids").where(f"{ID1} not like '%1'")
    matches = lists(p.where(f"{ID1} not like '%1'").union(p.where(f"{ID1} like '%5'").select(ID1, F.col(ID1))), "matched_entity_ids")
    return submission.submission_violations(candidates.union(candidates.where(f"{ID1} like '%2'")), matches, ids, c.where("entity_id not like '%9'"))


# ---- comparisons of runs, on a table with a row for each feature set and seed

_SETS_SQL = "case l_linenumber when 1 then 'baseline' when 2 then 'baseline_plus_name' when 3 then 'baseline_plus_address' else 'all' end"
_RUNS = f"runs as (select {_SETS_SQL} as feature_set, l_suppkey % 5 as seed, avg(l_discount) as validation_macro_f0_5, avg(l_tax) as validation_precision, max(l_quantity) as threshold, count(*) as candidate_count from lineitem group by all)"


def _runs(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return t.groupBy(F.expr(_SETS_SQL).alias("feature_set"), F.expr("l_suppkey % 5").alias("seed")).agg(F.avg("l_discount").alias("validation_macro_f0_5"), F.avg("l_tax").alias("validation_precision"), F.max("l_quantity").alias("threshold"), F.count("*").alias("candidate_count"))


_PAIRED = f"""with {_RUNS}, pd as (select a.feature_set, a.seed, b.validation_macro_f0_5 as baseline_macro_f0_5, a.validation_macro_f0_5 as feature_macro_f0_5, a.validation_macro_f0_5 - b.validation_macro_f0_5 as paired_improvement
  from runs a join runs b on b.seed = a.seed and b.feature_set = 'baseline' where a.feature_set <> 'baseline')"""


@query(f"{_PAIRED} select feature_set, seed, round(baseline_macro_f0_5, 9) as baseline_macro_f0_5, round(feature_macro_f0_5, 9) as feature_macro_f0_5, round(paired_improvement, 9) as paired_improvement from pd")
def paired_differences(spark, sf_dir):
    return rounded(errors.paired_differences(_runs(spark, sf_dir)), 9)


@query(f"{_PAIRED} select feature_set, count(*) as seeds, round(avg(paired_improvement), 9) as mean, round(coalesce(stddev_samp(paired_improvement), 0), 9) as paired_improvement_std, round(min(paired_improvement), 9) as min, round(max(paired_improvement), 9) as max from pd group by feature_set")
def paired_summary(spark, sf_dir):
    return rounded(errors.paired_summary(errors.paired_differences(_runs(spark, sf_dir))), 9)


_OF = ", ".join(f"round({f}({m})::double, 9) as {m}_{n}" for m in ("threshold", "validation_macro_f0_5", "validation_precision", "candidate_count") for f, n in (("avg", "mean"), ("stddev_pop", "std"), ("min", "min"), ("max", "max")))


@query(f"with {_RUNS} select feature_set, count(*) as seeds, {_OF} from runs group by feature_set")
def aggregate_results(spark, sf_dir):
    return rounded(errors.aggregate_results(_runs(spark, sf_dir)), 9)


# ---- features that all_features has, with SQL


_NUM = "list_filter({0}, lambda t: regexp_matches(t, '[\\p{{Nd}}]'))"
_CONTAIN = "case when len({0}) = 0 and len({1}) = 0 then 1.0 when len({0}) = 0 or len({1}) = 0 then 0.0 else len(list_intersect({0}, {1}))::double / len(list_distinct({0})) end"
_TOKEN = {
    "name_exact": "(a.name <> '' and a.name = b.name)::double", "address_exact": "(a.address <> '' and a.address = b.address)::double",
    "name_jaccard": _jac("a.nt", "b.nt"), "address_jaccard": _jac("a.adt", "b.adt"), "name_overlap": _ovl("a.nt", "b.nt"), "address_overlap": _ovl("a.adt", "b.adt"),
    "name_char_ngram_jaccard": _jac("a.ng", "b.ng"), "address_char_ngram_jaccard": _jac("a.ag", "b.ag"),
    "name_token_containment_s1": _CONTAIN.format("a.nt", "b.nt"), "name_token_containment_candidate": _CONTAIN.format("b.nt", "a.nt"), "address_token_containment_s1": _CONTAIN.format("a.adt", "b.adt"), "address_token_containment_candidate": _CONTAIN.format("b.adt", "a.adt"),
    "address_numeric_jaccard": _jac(_NUM.format("a.adt"), _NUM.format("b.adt")), "address_numeric_overlap": _ovl(_NUM.format("a.adt"), _NUM.format("b.adt")),
    "country_exact": "(a.country <> '' and a.country = b.country)::double", "country_nonempty_both": "(a.country <> '' and b.country <> '')::double", "country_missing_either": "(a.country = '' or b.country = '')::double", "country_both_missing": "(a.country = '' and b.country = '')::double",
    "name_length_ratio": _FOUR["name_length_ratio"], "address_length_ratio": _FOUR["name_length_ratio"].replace(".name", ".address"),
}


@query(f"{SCORED}, rg as materialized (select *, {_grams('name')} as ng, {_grams('address')} as ag from r) select s as source1_entity_id, c as candidate_entity_id, s[1:2] as source1_source, c[1:2] as candidate_source, " + ", ".join(f"round({v}, 9) as {k}" for k, v in _TOKEN.items()) + " from k join rg a on a.id = s join rg b on b.id = c")
def token_features(spark, sf_dir):
    _, s1, c = all_records(spark, sf_dir)
    return rounded(features.pair_features(default_pairs(s1, c), s1, c, tuple(_TOKEN)), 9)


_RATIO_NAMES = ("name_ratio", "name_token_sort_ratio", "address_ratio", "address_token_sort_ratio", "name_address_ratio_product", "name_address_ratio_min", "name_address_both_high")


def _texts(col, key):
    """SQL of ratios of all distinct pairs of a text, as KEY(a, b, v)."""
    return f"x{key} as materialized (select distinct a.{col} as a, b.{col} as b from k join rs a on a.id = s join rs b on b.id = c), {key} as materialized (select a, b, {_ratio('a', 'b')} as v from x{key})"


_KEYS = {"nr": "name", "ns": "ns", "ar": "address", "sa": "sa"}
_STEPS = ["tx0 as materialized (select s, c, " + ", ".join(f"a.{v} as a_{k}, b.{v} as b_{k}" for k, v in _KEYS.items()) + " from k join rs a on a.id = s join rs b on b.id = c)"]
_STEPS += [f"tx{i + 1} as materialized (select tx{i}.*, {k}.v as {k} from tx{i} join {k} on {k}.a = a_{k} and {k}.b = b_{k})" for i, k in enumerate(_KEYS)]


@query(f"""{SCORED}, rs as materialized (select *, array_to_string(list_sort(nt), ' ') as ns, array_to_string(list_sort(adt), ' ') as sa from r), {', '.join(_texts(v, k) for k, v in _KEYS.items())}, {', '.join(_STEPS)}
select s as source1_entity_id, c as candidate_entity_id, round(nr, 9) as name_ratio, round(ns, 9) as name_token_sort_ratio, round(ar, 9) as address_ratio, round(sa, 9) as address_token_sort_ratio,
  round(nr * ar, 9) as name_address_ratio_product, round(least(nr, ar), 9) as name_address_ratio_min, (nr >= 0.8 and ar >= 0.8)::double as name_address_both_high from tx4""")
def ratio_features(spark, sf_dir):
    _, s1, c = all_records(spark, sf_dir)
    return rounded(features.pair_features(default_pairs(s1, c), s1, c, _RATIO_NAMES).select(ID1, ID2, *_RATIO_NAMES), 9)


def _sets(col, key):
    """SQL of token set ratios of a token list for the default candidates, as KEY(s, c, v)."""
    only = "array_to_string(list_sort(list_distinct(list_filter({0}, lambda t: not list_contains({1}, t)))), ' ')"
    return f"""{key}0 as materialized (select s, c, a.{col} = b.{col} as same, len(a.{col}) = 0 or len(b.{col}) = 0 as none, array_to_string(list_sort(list_intersect(a.{col}, b.{col})), ' ') as i,
  {only.format(f'a.{col}', f'b.{col}')} as p, {only.format(f'b.{col}', f'a.{col}')} as q from k join r a on a.id = s join r b on b.id = c),
{key}1 as materialized (select *, trim(i || ' ' || p) as u, trim(i || ' ' || q) as w, i <> '' and (p = '' or q = '') as part from {key}0),
{key}x as materialized (select u as a, w as b from {key}1 where not (part or none) union select i, u from {key}1 where i <> '' and not part union select i, w from {key}1 where i <> '' and not part),
{key}y as materialized (select a, b, {_ratio('a', 'b')} as v from {key}x),
{key}2 as materialized (select {key}1.*, v as v1 from {key}1 left join {key}y on a = u and b = w), {key}3 as materialized (select {key}2.*, v as v2 from {key}2 left join {key}y on a = i and b = u), {key}4 as materialized (select {key}3.*, v as v3 from {key}3 left join {key}y on a = i and b = w),
{key} as materialized (select s, c, case when same then 1.0 when none then 0.0 when part then 1.0 else greatest(v1, case when i <> '' then v2 end, case when i <> '' then v3 end) end as v from {key}4)"""


@query(f"""{SCORED}, {_sets('nt', 'nv')}, {_sets('adt', 'av')} select s as source1_entity_id, c as candidate_entity_id, round(nv.v, 9) as name_token_set_ratio, round(av.v, 9) as address_token_set_ratio from nv join av using (s, c)""")
def token_set_features(spark, sf_dir):
    _, s1, c = all_records(spark, sf_dir)
    names = ("name_token_set_ratio", "address_token_set_ratio")
    return rounded(features.pair_features(default_pairs(s1, c), s1, c, names).select(ID1, ID2, *names), 9)


# ---- text forms


@query(f"{BASE} select id as entity_id, name as name_norm, address as address_norm, country as country_norm, src as source, array_to_string(nt, '|') as name_tokens, array_to_string(adt, '|') as address_tokens, array_to_string({_grams('name')}, '|') as name_grams from r")
def json_round_trip(spark, sf_dir):
    r = tsv.encode_lists(all_records(spark, sf_dir)[0].select(*records.PROCESSED))
    back = records.prepare_records(r)
    return back.select("entity_id", "name_norm", "address_norm", "country_norm", "source", *[F.array_join(c, "|").alias(c) for c in ("name_tokens", "address_tokens")], F.array_join("name_char_ngrams", "|").alias("name_grams"))


def _grams_of(n):
    return f"array_to_string(case when name = '' then [] when length(name) + 2 < {n} then ['^' || name || '$'] else list_transform(range(1, length(name) + 4 - {n}), lambda i: substr('^' || name || '$', i, {n})) end, '|')"


@query(f"{BASE} select id as entity_id, " + ", ".join(f"{_grams_of(n)} as grams_{n}" for n in (2, 4, 5)) + " from r")
def gram_sizes(spark, sf_dir):
    r = all_records(spark, sf_dir)[0]
    return r.select("entity_id", *[F.array_join(char_ngrams(F.col("name_norm"), n), "|").alias(f"grams_{n}") for n in (2, 4, 5)])


_MESSY = "coalesce(replace(substr(text, 1, 60), ' ', case when doc_id % 2 = 0 then ' , ' else ',,' end), '')"


@query(f"""with x as (select doc_id, trim({_MESSY}, ' ') as t from documents), y as (select doc_id, case when t = '' then [] else list_transform(string_split(t, ','), lambda i: trim(i, ' ')) end as a from x)
select doc_id, array_to_string(a, '|') as split, array_to_string(list_filter(a, lambda i: i <> ''), '|') as listed, len(list_distinct(list_filter(a, lambda i: i <> ''))) as distinct_ids from y""")
def id_lists(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.expr(_MESSY).alias("t"))
    return t.select("doc_id", F.array_join(tsv.split_ids(F.col("t")), "|").alias("split"), F.array_join(tsv.listed_ids(F.col("t")), "|").alias("listed"), F.size(tsv.parse_ids(F.col("t"))).cast("long").alias("distinct_ids"))


_MIXED = "case when p_size % 3 = 0 then p_name when p_size % 3 = 1 then p_size || '.5' else '' end"


@query(f"select p_partkey, try_cast({_MIXED} as double) as number from part")
def numeric_coercion(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/part.parquet")
    return t.select("p_partkey", records.numeric(F.expr(_MIXED)).alias("number"))
