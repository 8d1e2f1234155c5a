"""Queries over records made of the documents table, each with SQL that gives the same rows where SQL can."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalize
from ..operators import blocking, evaluate, features, models, submission
from .link import prepared

COUNTRY = "case when doc_id % 10 = 0 then '' else lang end"


def raw_records(spark, sf_dir):
    """Records: the source comes from doc_id, the name and address from two fields of the text; k1 and k2 stand for the rest of it."""
    rest = "nullif(substr(text, 141), '')"
    return spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(
        "concat('S', 1 + doc_id % 3, '-', doc_id) as entity_id", "coalesce(substr(text, 1, 60), '') as business_name",
        "coalesce(substr(text, 61, 80), '') as business_address", f"coalesce({COUNTRY}, '') as country", f"if({rest} is null, null, xxhash64({rest})) as k1", f"if({rest} is null, null, xxhash64({rest}, 1)) as k2")


def records(spark, sf_dir):
    """All, S1 and other records, normalised and kept: the Python part runs once for a query."""
    r = prepared(raw_records(spark, sf_dir))
    return r, r.where("source = 'S1'"), r.where("source <> 'S1'")


def links(r):
    """True links: equal texts beyond name and address."""
    a = r.where("source = 'S1'").select(F.col("entity_id").alias("source1_entity_id"), "k1", "k2")
    return a.join(r.where("source <> 'S1'").select(F.col("entity_id").alias("matched_entity_id"), "k1", "k2"), ["k1", "k2"]).drop("k1", "k2").distinct()


def truth_lists(r):
    """True links as comma lists, a row for each S1 record."""
    pairs = links(r).withColumnRenamed("matched_entity_id", "candidate_entity_id")
    return submission.lists_by_s1(pairs, universe(r.where("source = 'S1'")), "matched_entity_ids")


def universe(s1):
    return s1.select(F.col("entity_id").alias("source1_entity_id"))


def rounded(df, digits=6):
    """Doubles rounded, as sums in another order differ in their last bits."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def default_pairs(s1, c):
    return blocking.candidates(blocking.pair_table(s1, c))


def scored(spark, sf_dir):
    r, s1, c = records(spark, sf_dir)
    f = features.pair_features(default_pairs(s1, c), s1, c, ("name_jaccard", "address_jaccard"))
    return r, s1, f.select("source1_entity_id", "candidate_entity_id", F.greatest("name_jaccard", "address_jaccard").alias("match_probability"))


def _map(words):
    return "map {" + ", ".join(f"'{k}{dot}': '{v}'" for k, v in words.items() for dot in ("", ".")) + "}"


def _plain(x):
    return f"trim(regexp_replace(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}\\p{{M}}]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _norm(x, words):
    return _plain(f"array_to_string(list_transform(string_split_regex(regexp_replace(replace(lower(trim({x})), 'ß', 'ss'), '\\s*&\\s*', ' and ', 'g'), '\\s+'), lambda t: coalesce(({_map(words)})[t], t)), ' ')")


def _grams(x):
    return f"case when {x} = '' then [] when length({x}) < 1 then [] else list_transform(range(1, length({x}) + 1), lambda i: substr('^' || {x} || '$', i, 3)) end"


BASE = f"""with d as (select doc_id, 'S' || (1 + doc_id % 3) || '-' || doc_id as id, 'S' || (1 + doc_id % 3) as src,
  coalesce(substr(text, 1, 60), '') as nm, coalesce(substr(text, 61, 80), '') as ad, coalesce({COUNTRY}, '') as co, coalesce(substr(text, 141), '') as tail from documents),
r0 as materialized (select id, src, tail, {_norm('nm', normalize.NAME_WORDS)} as name, {_norm('ad', normalize.ADDRESS_WORDS)} as address, {_plain("replace(lower(trim(co)), 'ß', 'ss')")} as country from d),
r as materialized (select *, case when name = '' then [] else string_split(name, ' ') end as nt, case when address = '' then [] else string_split(address, ' ') end as adt from r0),
links as (select distinct a.id as s, b.id as c from r a join r b on a.tail = b.tail where a.src = 'S1' and b.src <> 'S1' and a.tail <> '')"""


def _pairs(name_cap=50, address_cap=50, bucket=500):
    def tokens(col, name, cap):
        return f"""t_{name} as materialized (select id, src, country, unnest(list_distinct({col})) as tok from r),
h_{name} as (select a.id as s, b.id as c, count(*) as n_{name} from t_{name} a join t_{name} b using (tok)
  where a.src = 'S1' and b.src <> 'S1' and (a.country = '' or b.country = '' or a.country = b.country)
  and tok in (select tok from t_{name} where src <> 'S1' group by tok having count(*) <= {cap}) group by all),
e_{name} as (select a.id as s, b.id as c, 1 as {name}_exact from r a join r b using ({name})
  where a.src = 'S1' and b.src <> 'S1' and {name} <> '' and (a.country = '' or b.country = '' or a.country = b.country)
  and {name} in (select {name} from r where src <> 'S1' group by {name} having count(*) <= {bucket}))"""

    return f"""{BASE}, {tokens('nt', 'name', name_cap)}, {tokens('adt', 'address', address_cap)},
p as materialized (select s, c, coalesce(n_name, 0) as n_name, coalesce(n_address, 0) as n_address, coalesce(name_exact, 0) as name_exact, coalesce(address_exact, 0) as address_exact
  from h_name full join h_address using (s, c) full join e_name using (s, c) full join e_address using (s, c))"""


def _rules(rules):
    return "array_to_string(list_filter([" + ", ".join(f"case when {blocking.CONDITIONS[x]} then '{x}' end" for x in rules) + "], lambda x: x is not null), '|')"


def _jac(a, b):
    return f"case when len({a}) = 0 and len({b}) = 0 then 1.0 when len({a}) = 0 or len({b}) = 0 then 0.0 else len(list_intersect({a}, {b}))::double / len(list_distinct(list_concat({a}, {b}))) end"


def _ovl(a, b):
    return f"case when len({a}) = 0 and len({b}) = 0 then 1.0 when len({a}) = 0 or len({b}) = 0 then 0.0 else len(list_intersect({a}, {b}))::double / least(len(list_distinct({a})), len(list_distinct({b}))) end"


DEFAULT = f"select * from (select s, c, {_rules(blocking.DEFAULT_RULES)} as rules from p) where rules <> ''"
SCORED = f"""{_pairs()}, k as ({DEFAULT}),
sc as materialized (select s, c, greatest({_jac('a.nt', 'b.nt')}, {_jac('a.adt', 'b.adt')}) as m from k join r a on a.id = s join r b on b.id = c)"""

Q, SQL = {}, {}


def query(sql=None):
    def put(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


@query(f"{BASE} select id as entity_id, name as name_norm, address as address_norm, country as country_norm, src as source, array_to_string(nt, '|') as name_tokens, array_to_string(adt, '|') as address_tokens, array_to_string({_grams('name')}, '|') as name_grams from r")
def normalize_records(spark, sf_dir):
    r, _, _ = records(spark, sf_dir)
    return r.select("entity_id", "name_norm", "address_norm", "country_norm", "source", *[F.array_join(c, "|").alias(c) for c in ("name_tokens", "address_tokens")], F.array_join("name_char_ngrams", "|").alias("name_grams"))


@query(f"{BASE}, t as (select unnest(list_distinct(adt)) as token from r where src <> 'S1') select token, count(*) as df from t group by token")
def token_frequency(spark, sf_dir):
    return blocking.token_frequency(records(spark, sf_dir)[2], "address_tokens")


@query(f"{_pairs()} select s as source1_entity_id, c as candidate_entity_id, c[1:2] as candidate_source, rules as blocking_rules from ({DEFAULT})")
def candidates_default(spark, sf_dir):
    _, s1, c = records(spark, sf_dir)
    return default_pairs(s1, c)


@query(f"{_pairs(25, 25, 3)} select s as source1_entity_id, c as candidate_entity_id, c[1:2] as candidate_source, rules as blocking_rules from (select s, c, {_rules(blocking.RULES)} as rules from p) where rules <> ''")
def candidates_all_rules_small_caps(spark, sf_dir):
    _, s1, c = records(spark, sf_dir)
    return blocking.candidates(blocking.pair_table(s1, c, blocking.BlockingConfig(25, 25, 3)), blocking.RULES)


def _one_rule(rule):
    @query(f"{_pairs()} select s as source1_entity_id, c as candidate_entity_id from p where {blocking.CONDITIONS[rule]}")
    def run(spark, sf_dir):
        _, s1, c = records(spark, sf_dir)
        return blocking.candidates(blocking.pair_table(s1, c), [rule]).select("source1_entity_id", "candidate_entity_id")

    Q["rule_" + rule], SQL["rule_" + rule] = Q.pop("run"), SQL.pop("run")


for _rule in blocking.RULES:
    _one_rule(_rule)

_N = " + ".join(f"({blocking.CONDITIONS[x]})::int" for x in blocking.DEFAULT_RULES)


@query(f"{_pairs()}, f as (select p.*, {_N} as n, l.s is not null as t from p left join links l using (s, c)) " + " union all ".join(f"select '{x}' as rule, count(*) as pairs, count(*) filter (n = 1) as unique_pairs, count(*) filter (n > 1) as overlap_pairs, count(*) filter (t) as true_links, count(*) filter (t and n = 1) as unique_true_links from f where {blocking.CONDITIONS[x]}" for x in blocking.DEFAULT_RULES))
def rule_contributions(spark, sf_dir):
    r, s1, c = records(spark, sf_dir)
    return blocking.rule_contributions(blocking.pair_table(s1, c), links(r))


@query(f"{SCORED}, u as (select id as s from r where src = 'S1'), n as (select s, count(*) as candidate_count, count(links.c) as retrieved_count from k left join links using (s, c) group by s), l as (select s, count(*) as truth_count from links group by s) select s as source1_entity_id, coalesce(candidate_count, 0) as candidate_count, coalesce(truth_count, 0) as truth_count, coalesce(retrieved_count, 0) as retrieved_count, round(retrieved_count / truth_count, 9) as recall from (select u.s, candidate_count, truth_count, case when truth_count > 0 then coalesce(retrieved_count, 0) else retrieved_count end as retrieved_count from u left join n using (s) left join l using (s))")
def candidates_by_s1(spark, sf_dir):
    r, s1, c = records(spark, sf_dir)
    per = evaluate.candidates_by_s1(default_pairs(s1, c), links(r), universe(s1))
    return per.withColumn("recall", F.round("recall", 9))


def _dist(n, keep="true", prefix=""):
    """SQL of the aggregates of a count over the rows that keep holds for."""
    f = f"filter ({keep})"
    cells = [f"count({n}) {f} as {prefix}entities", f"round(coalesce(avg({n}) {f}, 0), 6) as {prefix}mean"]
    cells += [f"round(coalesce(quantile_cont({n}, {q}) {f}, 0), 6) as {prefix}{k}" for k, q in evaluate.PERCENTILES.items()]
    cells += [f"coalesce(max({n}) {f}, 0)::bigint as {prefix}max", *[f"count(*) filter ({keep} and {n} {c}) as {prefix}{k}" for k, c in (("zero", "= 0"), ("one", "= 1"), *((f"le_{x}", f"<= {x}") for x in (5, 10, 20, 50, 100)), ("gt_100", "> 100"))]]
    return ", ".join(cells)


@query(f"{SCORED}, x as (select id, count(k.c) as n from r left join k on k.s = id where src = 'S1' group by id) select {_dist('n')} from x")
def candidate_distribution(spark, sf_dir):
    r, s1, c = records(spark, sf_dir)
    return rounded(evaluate.distribution(evaluate.candidates_by_s1(default_pairs(s1, c), links(r), universe(s1))))


@query(f"{SCORED} select s as source1_entity_id, c as candidate_entity_id, round({_jac('a.nt', 'b.nt')}, 9) as name_jaccard, round({_ovl('a.nt', 'b.nt')}, 9) as name_overlap, round({_jac('a.adt', 'b.adt')}, 9) as address_jaccard, (a.country <> '' and a.country = b.country)::double as country_exact, round(case when a.name = '' and b.name = '' then 1.0 when a.name = '' or b.name = '' then 0.0 else least(length(a.name), length(b.name))::double / greatest(length(a.name), length(b.name)) end, 9) as name_length_ratio from k join r a on a.id = s join r b on b.id = c")
def set_features(spark, sf_dir):
    _, s1, c = records(spark, sf_dir)
    names = ("name_jaccard", "name_overlap", "address_jaccard", "country_exact", "name_length_ratio")
    f = features.pair_features(default_pairs(s1, c), s1, c, names)
    return f.select("source1_entity_id", "candidate_entity_id", *[F.round(n, 9).alias(n) for n in names])


@query()
def all_features(spark, sf_dir):
    _, s1, c = records(spark, sf_dir)
    return features.pair_features(default_pairs(s1, c), s1, c, features.feature_set("all"))


def _cosine(field):
    """SQL of TF-IDF cosines of the default candidates, as dot_FIELD(s, c, x)."""
    return f"""g_{field} as (select id, unnest(flatten(list_transform([3, 4, 5], lambda n: list_transform(range(1, length({field}) - n + 2), lambda i: substr({field}, i, n))))) as gram from r),
tf_{field} as (select id, gram, count(*) as tf from g_{field} group by all), df_{field} as (select gram, count(*) as df from tf_{field} group by gram),
w_{field} as (select id, gram, tf * (ln((1.0 + (select count(*) from r)) / (1 + df)) + 1) as w from tf_{field} join df_{field} using (gram)),
z_{field} as materialized (select id, gram, w / sqrt(sum(w * w) over (partition by id)) as w from w_{field}),
dot_{field} as (select s, c, sum(a.w * b.w) as x from k join z_{field} a on a.id = s join z_{field} b on b.id = c and b.gram = a.gram group by all)"""


@query(f"""{SCORED}, {_cosine('name')}, {_cosine('address')}
select s as source1_entity_id, c as candidate_entity_id, round(coalesce(a.x, 0), 6) as name_tfidf_cosine, round(coalesce(b.x, 0), 6) as address_tfidf_cosine, round(coalesce(a.x, 0) * coalesce(b.x, 0), 6) as name_address_tfidf_product
from k left join dot_name a using (s, c) left join dot_address b using (s, c)""")
def tfidf_cosine(spark, sf_dir):
    _, s1, c = records(spark, sf_dir)
    names = ("name_tfidf_cosine", "address_tfidf_cosine", "name_address_tfidf_product")
    return rounded(features.pair_features(default_pairs(s1, c), s1, c, names).select("source1_entity_id", "candidate_entity_id", *names))


def _ratio(a, b):
    """SQL of the indel ratio; texts of up to 126 characters."""
    lcs = f"""len({a}) - bit_count(list_reduce(list_prepend((1::hugeint << len({a})::int) - 1,
  list_transform(string_split({b}, ''), lambda ch: list_sum(list_transform(range(1, len({a}) + 1), lambda i: case when substr({a}, i, 1) = ch then 1::hugeint << (i - 1)::int else 0::hugeint end))::hugeint)),
  lambda x, m: ((x + (x & m)) | (x - (x & m))) & ((1::hugeint << len({a})::int) - 1)))"""
    return f"case when {a} = {b} then 1.0 when {a} = '' or {b} = '' then 0.0 else 2.0 * ({lcs}) / (length({a}) + length({b})) end"


@query(f"{SCORED}, x as materialized (select distinct a.name as a, b.name as b from k join r a on a.id = s join r b on b.id = c), y as materialized (select a, b, {_ratio('a', 'b')} as v from x) select s as source1_entity_id, c as candidate_entity_id, round(v, 9) as name_ratio from k join r a on a.id = s join r b on b.id = c join y on y.a = a.name and y.b = b.name")
def name_ratio(spark, sf_dir):
    _, s1, c = records(spark, sf_dir)
    return rounded(features.pair_features(default_pairs(s1, c), s1, c, ("name_ratio",)).select("source1_entity_id", "candidate_entity_id", "name_ratio"), 9)


_GRID = f"""{SCORED}, g as (select i * 0.05::double as threshold from range(21) t(i)), l as (select s, count(*) as n from links group by s),
av as (select s, count(*) as n from links join sc using (s, c) group by s),
h as (select threshold, sc.s, count(*) as n, count(links.c) as tp from sc join g on m >= threshold left join links on links.s = sc.s and links.c = sc.c group by all),
q as (select g.threshold, u.id as s, coalesce(h.n, 0) as n, coalesce(h.tp, 0) as tp, coalesce(l.n, 0) as t, coalesce(av.n, 0) as a
  from g cross join (select id from r where src = 'S1') u left join h on h.threshold = g.threshold and h.s = u.id left join l on l.s = u.id left join av on av.s = u.id)"""
_REPORT = """select threshold, sum(tp)::bigint as tp, sum(n - tp)::bigint as fp, sum(t - tp)::bigint as fn, sum(a)::bigint as available, sum(t - a)::bigint as lost, sum(a - tp)::bigint as missed, sum(n)::bigint as predicted,
  avg(case when n = 0 and t = 0 then 1.0 when tp = 0 then 0.0 else 1.25 * (tp / n) * (tp / t) / (0.25 * (tp / n) + tp / t) end) as f from q group by threshold"""


def _report(spark, sf_dir):
    r, s1, sc = scored(spark, sf_dir)
    return evaluate.threshold_report(sc, links(r), universe(s1))


@query(f"{_GRID} select round(threshold, 6) as threshold, tp, fp, fn, available, lost, missed, predicted, round(f, 6) as macro_f05, round(case when predicted = 0 then 0 else tp / predicted end, 6) as precision, round(case when tp + fn = 0 then 0 else tp / (tp + fn) end, 6) as recall from ({_REPORT})")
def threshold_report(spark, sf_dir):
    return rounded(_report(spark, sf_dir))


@query(f"{_GRID} select round(threshold, 6) as threshold from ({_REPORT}) order by round(f, 9) desc, threshold desc limit 1")
def best_threshold(spark, sf_dir):
    return rounded(evaluate.best_threshold(_report(spark, sf_dir)))


@query(f"{SCORED} select i::int as band, count(m) as pairs from range(6) t(i) left join sc on i = case when m >= 0.95 then 5 when m >= 0.9 then 4 when m >= 0.75 then 3 when m >= 0.5 then 2 when m >= 0.25 then 1 else 0 end group by i")
def score_bands(spark, sf_dir):
    return evaluate.score_bands(scored(spark, sf_dir)[2])


@query(f"{SCORED} select id as source1_entity_id, coalesce(string_agg(sc.c, ',' order by sc.c), '') as matched_entity_ids from r left join sc on sc.s = id and m >= 0.5 where src = 'S1' group by id")
def submission_lists(spark, sf_dir):
    _, s1, sc = scored(spark, sf_dir)
    return submission.lists_by_s1(sc.where("match_probability >= 0.5"), universe(s1), "matched_entity_ids")


_FOUR = {"name_jaccard": _jac("a.nt", "b.nt"), "address_jaccard": _jac("a.adt", "b.adt"), "country_exact": "(a.country <> '' and a.country = b.country)::double", "name_length_ratio": "case when a.name = '' and b.name = '' then 1.0 when a.name = '' or b.name = '' then 0.0 else least(length(a.name), length(b.name))::double / greatest(length(a.name), length(b.name)) end"}
_LABELLED = f"""{SCORED}, f as materialized (select (l.s is not null)::int as label, {', '.join(f'{v} as {k}' for k, v in _FOUR.items())}
  from k join r a on a.id = k.s join r b on b.id = k.c left join links l on l.s = k.s and l.c = k.c)"""
_DIAGNOSE = " union all ".join(f"""(select '{n}' as feature, 'double' as dtype, avg(({n} is null)::int) as missing_rate, avg(({n} = 0)::int) as zero_rate, count(distinct {n}) as unique_values,
  count(distinct {n}) <= 1 as constant, count(distinct {n}) <= 2 or (select max(k) from (select count(*) as k from f group by {n})) >= 0.99 * count(*) as nearly_constant, round(avg({n}), 6) as overall_mean, round(stddev_pop({n}), 6) as overall_std,
  count(*) filter (label = 1) as positive_count, count(*) filter (label = 0) as negative_count, round(avg({n}) filter (label = 1), 6) as positive_mean, round(avg({n}) filter (label = 0), 6) as negative_mean,
  round(stddev_pop({n}) filter (label = 1), 6) as positive_std, round(stddev_pop({n}) filter (label = 0), 6) as negative_std, round(median({n}) filter (label = 1), 6) as positive_median, round(median({n}) filter (label = 0), 6) as negative_median,
  round(avg({n}) filter (label = 1) - avg({n}) filter (label = 0), 6) as mean_difference,
  round((avg({n}) filter (label = 1) - avg({n}) filter (label = 0)) / nullif(sqrt((var_pop({n}) filter (label = 1) + var_pop({n}) filter (label = 0)) / 2), 0), 6) as standardized_mean_difference,
  (select round((sum(mid) filter (label = 1) - count(*) filter (label = 1) * (count(*) filter (label = 1) + 1) / 2) / (count(*) filter (label = 1) * count(*) filter (label = 0)), 6)
    from (select label, rank() over (order by {n}) + (count(*) over (partition by {n}) - 1) / 2 as mid from f)) as univariate_auc from f)""" for n in _FOUR)


def _four(spark, sf_dir):
    r, s1, c = records(spark, sf_dir)
    return features.with_labels(features.pair_features(default_pairs(s1, c), s1, c, tuple(_FOUR)), links(r))


@query(f"{_LABELLED} {_DIAGNOSE}")
def feature_diagnostics(spark, sf_dir):
    return rounded(evaluate.diagnose(_four(spark, sf_dir), tuple(_FOUR)))


@query(f"{_LABELLED} " + " union all ".join(f"select '{a}' as feature_a, '{b}' as feature_b, case when isnan(corr({a}, {b})) then null else round(corr({a}, {b}), 6) end as correlation from f" for i, a in enumerate(_FOUR) for b in list(_FOUR)[i + 1:]))
def feature_correlations(spark, sf_dir):
    return rounded(evaluate.correlations(_four(spark, sf_dir), tuple(_FOUR)))


@query()
def logistic_scores(spark, sf_dir):
    r, s1, c = records(spark, sf_dir)
    names = ("name_jaccard", "name_overlap", "address_jaccard", "address_overlap", "country_exact", "name_length_ratio")
    f = features.with_labels(features.pair_features(default_pairs(s1, c), s1, c, names), links(r))
    return models.LogisticScorer().fit(f, names).predict(f).select("source1_entity_id", "candidate_entity_id", "match_probability")
