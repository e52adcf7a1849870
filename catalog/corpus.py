"""Corpus statistics over the document table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import review, stats
from sievework.operators.dedup import exact_duplicate_groups, exact_duplicate_members

from .common import first_line, hashed, normal_form, table, tokens

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f
    return add


def rounded(df, places=6):
    """Doubles at a fixed number of places, as the SQL gives them."""
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def docs(spark, d):
    return table(spark, d, "documents")


# ---- SQL of the view statistics -------------------------------------------------

def _on(left, right, by):
    return " and ".join(f"{left}.{b} is not distinct from {right}.{b}" for b in by)


def _moments(v):
    return f"""round(avg({v}), 6) as {v}_mean, round(quantile_cont({v}, 0.5), 6) as {v}_median,
      round(stddev_pop({v}), 6) as {v}_std, min({v}) as {v}_min, max({v}) as {v}_max, round(quantile_cont({v}, 0.95), 6) as {v}_p95"""


def _view_sql(by, kind, columns, sample=300):
    keys = ", ".join(by) if by else "one"
    names = list(by) if by else ["one"]
    part = f"partition by {keys}"
    grams = " union all ".join(f"select {keys}, {n} as n, {g} as g from o where {g} is not null" for n, g in (
        (1, "t1"), (2, "t1 || ' ' || t2"), (3, "t1 || ' ' || t2 || ' ' || t3")))
    ratio = ", ".join(f"""round(coalesce(count(distinct g) filter (n = {n}) / nullif(count(*) filter (n = {n}), 0), 0), 6) as distinct_{n}"""
                      for n in (1, 2, 3))
    return f"""with f as (select *, 1 as one, {tokens('text', kind)} as w, {normal_form('text', kind)} as form from documents),
    l as (select {keys}, {_moments('chars')}, {_moments('words')} from (select {keys}, length(text) as chars, len(w) as words from f) group by all),
    u as (select {keys}, count(*) as count, count(distinct form) as unique_normalized, count(*) - count(distinct form) as exact_duplicates,
      round((count(*) - count(distinct form)) / count(*), 6) as duplicate_rate from f group by {keys}),
    t as (select doc_id, {keys}, unnest(w) as t1, generate_subscripts(w, 1) as i from f),
    o as (select *, lead(t1) over (partition by doc_id, {keys} order by i) as t2, lead(t1, 2) over (partition by doc_id, {keys} order by i) as t3 from t),
    g as (select {keys}, count(*) filter (n = 1) as total_tokens, count(distinct g) filter (n = 1) as vocab,
      round(count(distinct g) filter (n = 1) / count(*) filter (n = 1), 6) as ttr, {ratio} from ({grams}) group by {keys}),
    p as (select {keys}, list_distinct(w) as w, row_number() over ({part} order by {hashed(0, 'doc_id')}, doc_id) - 1 as r from f),
    j as (select {', '.join('a.' + k for k in names)}, case when len(a.w) = 0 or len(b.w) = 0 then 0 else
        len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) end as j
      from p a join p b on {_on('a', 'b', names)} and a.r % 10 = 0 and b.r > a.r and b.r < a.r + 10 where a.r < {sample} and b.r < {sample}),
    s as (select {keys}, round(avg(j), 6) as jaccard_mean, round(quantile_cont(j, 0.95), 6) as jaccard_p95, round(max(j), 6) as jaccard_max,
      round(avg(case when j > 0.8 then 1 else 0 end), 6) as jaccard_share_gt_08, count(*) as jaccard_pairs from j group by {keys})
    select {', '.join(['u.' + b for b in by] + [columns])}
    from u join l on {_on('u', 'l', names)} left join g on {_on('u', 'g', names)} left join s on {_on('u', 's', names)}"""


_LENGTHS = ", ".join(f"{v}_{m}" for v in ("chars", "words") for m in ("mean", "median", "std", "min", "max", "p95"))
_COUNTS = "count, unique_normalized, exact_duplicates, duplicate_rate"
_GRAMS = ", ".join(f"coalesce({c}, 0) as {c}" for c in ("total_tokens", "vocab", "ttr", "distinct_1", "distinct_2", "distinct_3"))
_SAMPLE = ", ".join(f"coalesce({c}, 0) as {c}" for c in
                    ("jaccard_mean", "jaccard_p95", "jaccard_max", "jaccard_share_gt_08", "jaccard_pairs"))
_VIEW = ", ".join((_COUNTS, _LENGTHS, _GRAMS, _SAMPLE))


@query(_view_sql((), "word", _VIEW))
def view_stats(spark, d):
    return rounded(stats.view_stats(docs(spark, d), "text", "doc_id", kind="word").drop("duplicate_groups"))


@query(_view_sql(("lang",), "bn", _VIEW))
def view_stats_by_lang(spark, d):
    return rounded(stats.view_stats(docs(spark, d), "text", "doc_id", ["lang"]).drop("duplicate_groups"))


@query(_view_sql(("lang", "source"), "bn", """count as n, coalesce(distinct_2, 0) as distinct_2, coalesce(ttr, 0) as ttr, duplicate_rate,
  coalesce(jaccard_mean, 0) as jaccard_mean"""))
def combo_stats(spark, d):
    found = stats.view_stats(docs(spark, d), "text", "doc_id", ["lang", "source"])
    return rounded(found.select("lang", "source", F.col("count").alias("n"), "distinct_2", "ttr", "duplicate_rate", "jaccard_mean"))


@query(_view_sql(("lang",), "bn", _LENGTHS))
def length_stats(spark, d):
    return rounded(stats.length_stats(docs(spark, d), "text", ["lang"]))


@query(_view_sql(("source",), "word", _GRAMS))
def distinct_n(spark, d):
    return rounded(stats.ngram_stats(docs(spark, d), "text", ["source"], "word"))


@query(_view_sql(("source",), "bn", _SAMPLE))
def jaccard_sample(spark, d):
    return rounded(stats.jaccard_sample(docs(spark, d), "text", "doc_id", ["source"]))


@query(f"""with c as (select lang, {normal_form('text')} as form, count(*) as n from documents group by all)
  select lang, sum(n)::bigint as count, count(*) as unique_normalized, (sum(n) - count(*))::bigint as exact_duplicates,
    round((sum(n) - count(*)) / sum(n), 6) as duplicate_rate, count(*) filter (n > 1) as duplicate_groups from c group by lang""")
def duplicate_stats(spark, d):
    return rounded(stats.duplicate_stats(docs(spark, d), "text", ["lang"]))


@query(f"""select substr(form, 1, 150) as normalized, count(*) as count, min(doc_id) as first_id
  from (select doc_id, {normal_form('text')} as form from documents) group by form having count(*) > 1
  order by count desc, first_id limit 5""")
def duplicate_examples(spark, d):
    return stats.duplicate_examples(docs(spark, d), "text", "doc_id")


@query("""select replace(substr(text, 1, 80), chr(10), ' | ') as start, count(*) as count, min(doc_id) as first_id
  from documents group by start order by count desc, first_id limit 5""")
def top_starts(spark, d):
    return stats.top_starts(docs(spark, d), "text", "doc_id")


@query("""select min(doc_id) as first_id, count(*) as count, substr(text, 1, 2000) as message from documents
  group by text having count(*) > 1""")
def exact_dup_groups(spark, d):
    return exact_duplicate_groups(docs(spark, d), "text", "doc_id")


@query("""select first_id, count, doc_id from (select doc_id, min(doc_id) over (partition by text) as first_id,
  count(*) over (partition by text) as count from documents) where count > 1""")
def exact_dup_members(spark, d):
    return exact_duplicate_members(docs(spark, d), "text", "doc_id")


def _entropy_sql(value, by):
    keys = f"{by}, " if by else ""
    group = f"group by {by}" if by else ""
    return f"""with c as (select {keys}{value}, count(*) as c from documents group by all),
      p as (select *, c / sum(c) over ({'partition by ' + by if by else ''}) as p from c)
    select {keys}count(*) as classes, round(case when count(*) > 1 then -sum(p * log2(p)) else 0 end, 6) as entropy,
      round(case when count(*) > 1 then log2(count(*)) else 0 end, 6) as max_entropy,
      round(case when count(*) > 1 then -sum(p * log2(p)) / log2(count(*)) else 0 end, 6) as entropy_norm from p {group}"""


@query(_entropy_sql("source", ""))
def entropy_source(spark, d):
    return rounded(stats.entropy(docs(spark, d), "source"))


@query(_entropy_sql("source", "lang"))
def entropy_by_lang(spark, d):
    return rounded(stats.entropy(docs(spark, d), "source", ["lang"]))


@query(f"""with c as (select lang, {first_line('text')} as v, count(*) as c from documents group by all),
  r as (select *, row_number() over (partition by lang order by c desc) as r, count(*) over (partition by lang) as k from c)
  select lang, count(*) as values, count(*) filter (c = 1) as singletons, count(*) filter (c > 1) as repeated,
    round(sum(c) filter (r <= 5) / sum(c), 6) as top_cover,
    round(sum(c) filter (r <= greatest(1, floor(k * 0.1))) / sum(c), 6) as head_cover from r group by lang""")
def head_coverage(spark, d):
    lines = docs(spark, d).withColumn("line", F.substring_index("text", "\n", 1))
    return rounded(stats.head_coverage(lines, "line", ["lang"]))


@query("select lang, source, count(*) as count from documents group by all")
def two_key_counts(spark, d):
    return stats.value_counts(docs(spark, d), "lang", "source")


@query("select source as value, count(*) as count, min(doc_id) as first_id from documents group by 1 order by count desc, first_id limit 10")
def top_sources(spark, d):
    return stats.top_values(docs(spark, d), F.col("source"), "doc_id", 10)


_CLASSES = [str(i) for i in range(12)] + ["x"]
_CLASS = "case when doc_id % 13 = 12 then 'x' else cast(doc_id % 13 as string) end"


@query(f"""select case when grouping(lang) = 1 then 'total' else lang end as lang,
  {', '.join(f"count(*) filter (class = '{c}') as {chr(34)}{c}{chr(34)}" for c in _CLASSES)}, count(*) as total
  from (select lang, {_CLASS} as class from documents) group by rollup (lang)""")
def class_matrix(spark, d):
    rows = docs(spark, d).withColumn("class", F.expr(_CLASS))
    values, more = stats.frequent_values(rows, "class")
    return stats.count_matrix(rows, "lang", "class", values, other="other" if more else None)


@query("""with t as (select length(text) + length(lang) as v from documents), o as (select list_sort(list(v)) as s, count(*) as n, sum(v) as t from t)
  select n as rows, floor(t / n)::bigint as mean_chars, s[n // 2 + 1] as p50_chars, s[floor(n * 0.95)::bigint + 1] as p95_chars,
    s[n] as max_chars, floor(t / 4)::bigint as est_tokens from o""")
def size_audit(spark, d):
    return stats.size_audit(docs(spark, d), ["text", "lang"])


@query("""select count(*) as rows, count(*) filter (a is null or a = '' or b is null or b = '') as missing from
  (select case when doc_id % 11 = 0 then '' else text end as a, case when doc_id % 7 = 0 then null else source end as b from documents)""")
def missing_answers(spark, d):
    rows = docs(spark, d).select(
        F.expr("case when doc_id % 11 = 0 then '' else text end").alias("a"),
        F.expr("case when doc_id % 7 = 0 then null else source end").alias("b"))
    return stats.missing_answers(rows, ["a", "b"])


@query("select * from (" + " union all ".join(f"""select '{c}' as metric, count({e}) as count, round(avg({e}), 6) as mean,
  round(stddev_samp({e}), 6) as std, min({e})::double as min, quantile_cont({e}, 0.25)::double as p25, quantile_cont({e}, 0.5)::double as p50,
  quantile_cont({e}, 0.75)::double as p75, max({e})::double as max from documents"""
  for c, e in (("n_chars", "n_chars"), ("score", "case when doc_id % 5 = 0 then null else doc_id % 7 end"))) + ")")
def describe_scores(spark, d):
    rows = docs(spark, d).select("n_chars", F.expr("case when doc_id % 5 = 0 then null else doc_id % 7 end").alias("score"))
    return rounded(stats.describe_scores(rows, ["n_chars", "score"]))


def _score_sql():
    inner = _view_sql(("lang",), "bn", """coalesce(jaccard_mean, 0) as m, coalesce(distinct_2, 0) as d2,
      (count - unique_normalized) / count as dup""")
    return f"""with v as ({inner}), e as ({_entropy_sql('source', 'lang')})
      select v.lang, round(100 * (0.35 * (1 - greatest(0, least(1, m))) + 0.25 * d2 + 0.2 * (1 - dup) + 0.2 * entropy_norm), 2) as score,
        round(100 * (0.35 * (1 - greatest(0, least(1, m))) + 0.25 * d2 + 0.2 * (1 - dup) + 0.1), 2) as score_neutral
      from v join e on v.lang = e.lang"""


@query(_score_sql())
def diversity_score(spark, d):
    found = stats.view_stats(docs(spark, d), "text", "doc_id", ["lang"])
    mixed = found.join(stats.entropy(docs(spark, d), "source", ["lang"]), "lang")
    return mixed.select(
        "lang", F.round(stats.diversity_score(entropy_norm=F.col("entropy_norm")), 2).alias("score"),
        F.round(stats.diversity_score(), 2).alias("score_neutral"))


_CELLS = "select lang, source, doc_id % 13 as class, n_chars // 4000 as size from documents"


@query(f"""with c as ({_CELLS}), g as (select grouping(lang) as a, grouping(source) as b, grouping(class) as c, grouping(size) as d, count(*) as rows from c group by cube (lang, source, class, size)),
  s as (select a, b, c, d, count(*) as seen, max(rows) as largest, sum(rows)::bigint as rows from g group by all),
  v as (select max(seen) filter (a = 0 and b + c + d = 3) as va, max(seen) filter (b = 0 and a + c + d = 3) as vb, max(seen) filter (c = 0 and a + b + d = 3) as vc,
    max(seen) filter (d = 0 and a + b + c = 3) as vd from s),
  p as (select *, (case when a = 0 then va else 1 end * case when b = 0 then vb else 1 end * case when c = 0 then vc else 1 end * case when d = 0 then vd else 1 end)::bigint as possible from s, v)
  select concat_ws(',', case when a = 0 then 'lang' end, case when b = 0 then 'source' end, case when c = 0 then 'class' end, case when d = 0 then 'size' end) as dimensions,
    rows, seen, possible, possible - seen as empty, round(seen / possible, 6) as covered, largest from p""")
def coverage_matrix(spark, d):
    rows = docs(spark, d).select("lang", "source", F.expr("doc_id % 13").alias("class"), F.expr("n_chars div 4000").alias("size"))
    return rounded(review.coverage_matrix(rows, ["lang", "source", "class", "size"]))


@query(f"""with c as ({_CELLS}) select a.lang, b.source, d.class from (select distinct lang from c) a, (select distinct source from c) b, (select distinct class from c) d
  where not exists (select 1 from c where c.lang = a.lang and c.source = b.source and c.class = d.class)""")
def coverage_gaps(spark, d):
    rows = docs(spark, d).select("lang", "source", F.expr("doc_id % 13").alias("class"))
    return review.empty_cells(rows, ["lang", "source", "class"])


@query("""with s as (select lang, source, count(*) as size from documents group by all), t as (select least(120, count(*)) as n, count(*) as total from documents),
  q as (select *, size * n // total as base, size * n % total as rest from s, t),
  a as (select *, base + (row_number() over (order by rest desc, lang nulls first, source nulls first) <= n - sum(base) over ())::int as take from q),
  r as (select d.doc_id, d.lang, d.source, row_number() over (partition by d.lang, d.source order by md5(concat('42|', d.doc_id)), d.doc_id) as place, a.take
    from documents d join a on a.lang is not distinct from d.lang and a.source is not distinct from d.source)
  select doc_id, lang, source, place from r where place <= take""")
def review_sample(spark, d):
    return review.review_sample(docs(spark, d), "doc_id", ["lang", "source"], 120).select("doc_id", "lang", "source", "place")
