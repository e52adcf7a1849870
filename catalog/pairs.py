"""Similarity, near-duplicates, TF-IDF and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import vectors
from sievework.operators import neardup, retrieval, similarity, tfidf as tf, threshold

from .common import table, tokens
from .corpus import rounded

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f
    return add


def embeddings(spark, d):
    return table(spark, d, "embeddings")


_UNIT = "list_transform(embedding::double[], lambda x: x / (sqrt(list_inner_product(embedding::double[], embedding::double[])) + 1e-12))"
_PAIRS = """select a.vec_id as i, b.vec_id as j, a.label, a.label = b.label as same,
  greatest(-1, least(1, list_inner_product(a.embedding::double[], b.embedding::double[]))) as s
  from embeddings a join embeddings b on a.vec_id < b.vec_id"""


@query(f"""select vec_id, round(list_sum(u), 6) as total, round(list_inner_product(u, u), 6) as size, round(u[1], 6) as first,
  round(list_cosine_similarity(embedding::double[], list_reverse(embedding::double[])), 6) as cosine
  from (select *, {_UNIT} as u from embeddings)""")
def emb_unit(spark, d):
    rows = embeddings(spark, d).withColumn("u", vectors.l2_normalize("embedding"))
    total = F.aggregate("u", F.lit(0.0), lambda a, x: a + x)
    return rounded(rows.select(
        "vec_id", total.alias("total"), vectors.dot("u", "u").alias("size"), F.get("u", F.lit(0)).alias("first"),
        vectors.cosine("embedding", F.reverse("embedding")).alias("cosine")))


def _letter_counts():
    return lambda texts: [[t.count(c) for c in "aeio "] for t in texts]


@query("""select doc_id, length(text) - length(replace(text, 'a', '')) as a, length(text) - length(replace(text, ' ', '')) as spaces, 5 as dimensions,
  round(sqrt(list_sum(list_transform(['a', 'e', 'i', 'o', ' '], lambda c: power(length(text) - length(replace(text, c, '')), 2)))), 6) as size from documents""")
def encoder_hook(spark, d):
    """Vectors of a caller's encoder, here counts of five characters."""
    found = vectors.encoded(table(spark, d, "documents"), "doc_id", "text", _letter_counts)
    return rounded(found.select(
        "doc_id", F.get("vector", F.lit(0)).cast("long").alias("a"), F.get("vector", F.lit(4)).cast("long").alias("spaces"),
        F.size("vector").alias("dimensions"), vectors.norm("vector").alias("size")))


_STATS = """count(*) as n_pairs, round(avg(s), 6) as mean, round(stddev_pop(s), 6) as std, round(quantile_cont(s, 0.5), 6) as median,
  round(quantile_cont(s, 0.95), 6) as p95, round(quantile_cont(s, 0.99), 6) as p99, round(min(s), 6) as min, round(max(s), 6) as max,
  round(avg((s > 0.7)::int), 6) as share_gt_70, round(avg((s > 0.8)::int), 6) as share_gt_80, round(avg((s > 0.85)::int), 6) as share_gt_85"""


@query(f"select {_STATS} from ({_PAIRS})")
def emb_pair_stats(spark, d):
    return rounded(similarity.pair_stats(embeddings(spark, d), "vec_id", "embedding"))


@query(f"select label, {_STATS} from ({_PAIRS}) where same group by label")
def emb_pair_stats_by_label(spark, d):
    return rounded(similarity.pair_stats(embeddings(spark, d), "vec_id", "embedding", ["label"]))


@query(f"select label, count(*) as n_pairs, round(avg(s), 6) as mean, round(stddev_pop(s), 6) as std from ({_PAIRS}) where same group by label")
def emb_moments(spark, d):
    return rounded(similarity.cosine_moments(embeddings(spark, d), "embedding", ["label"]))


@query(f"select (select count(*) from embeddings) as n, round(avg(s), 6) as mean from ({_PAIRS})")
def emb_mean(spark, d):
    return rounded(similarity.mean_cosine(embeddings(spark, d), "embedding"))


@query(f"""select rank, p.i, p.j, round(score, 6) as score,
    replace(substr(x.text, 1, 200), chr(10), ' | ') as a_preview, replace(substr(y.text, 1, 200), chr(10), ' | ') as b_preview
  from (select row_number() over (order by score desc, i, j) as rank, i, j, score
    from (select i, j, round(s, 9) as score from ({_PAIRS})) order by rank limit 20) p
  left join documents x on x.doc_id = p.i left join documents y on y.doc_id = p.j""")
def emb_top_pairs(spark, d):
    pairs = similarity.top_pairs(embeddings(spark, d), "vec_id", "embedding", 20)
    return rounded(similarity.with_previews(pairs, table(spark, d, "documents"), "doc_id", "text"))


_SHARES = """count(*) as n_pairs, round(avg((s > 0.7)::int), 9) as share_gt_70, round(avg((s > 0.8)::int), 9) as share_gt_80, round(avg((s > 0.85)::int), 9) as share_gt_85"""


@query(f"select label, {_SHARES.replace('0.85', '0.35').replace('0.8)', '0.3)').replace('0.7)', '0.25)')} from ({_PAIRS}) where same group by label")
def emb_shares_by_label(spark, d):
    """Shares above lower thresholds than usual, as these vectors lie far apart."""
    found = similarity.shares_above(embeddings(spark, d), "vec_id", "embedding", ["label"], {"share_gt_70": 0.25, "share_gt_80": 0.3, "share_gt_85": 0.35})
    return found.select("label", "n_pairs", *[F.round(c, 9).alias(c) for c in similarity.SHARES])


def _greedy_sql(rows, edges):
    """The rule as stated: walk the ids in order, keep a row unless an earlier
    kept one is too similar. ``edges``: id, other (earlier), sim."""
    return f"""with recursive edges as materialized ({edges}), n as materialized (select id, list(other) as near from edges group by id),
    o as materialized (select id, near, row_number() over (order by id) as r from n),
    heads as (select list(distinct other) as k from edges where other not in (select id from n)),
    walk(r, k) as (select 0, k from heads union all
      select o.r, case when list_has_any(w.k, o.near) then w.k else list_append(w.k, o.id) end from walk w join o on o.r = w.r + 1),
    done as materialized (select k from walk order by r desc limit 1),
    found as (select id, min(other) as vs, arg_min(sim, other) as sim from edges where list_contains((select k from done), other) group by id)
    select a.id, f.vs is null as kept, f.vs, round(f.sim, 6) as sim from ({rows}) a left join found f on a.id = f.id"""


@query(_greedy_sql("select vec_id as id from embeddings", f"select j as id, i as other, s as sim from ({_PAIRS}) where same and s > 0.3"))
def emb_semantic_dedup(spark, d):
    return rounded(neardup.dedup_by_vector(embeddings(spark, d), "vec_id", "embedding", ["label"], 0.3))


_SETS = f"""select doc_id as id, lang, list_distinct({tokens("concat(lang, ' ', chr(10), ' ', text)")}) as w from documents"""


@query(_greedy_sql("select doc_id as id from documents", f"""select id, other, c / (na + nb - c) as sim from (
    select b.id, a.id as other, len(a.w) as na, len(b.w) as nb, len(list_intersect(a.w, b.w)) as c
    from ({_SETS}) a join ({_SETS}) b on a.lang = b.lang and a.id < b.id and least(len(a.w), len(b.w)) > 0.5 * greatest(len(a.w), len(b.w)))
  where c / (na + nb - c) > 0.5"""))
def jaccard_dedup(spark, d):
    rows = table(spark, d, "documents").withColumn("pair", neardup.pair_text(F.col("lang"), F.col("text")))
    return rounded(neardup.dedup_by_tokens(rows, "doc_id", "pair", ["lang"], 0.5))


# ---- TF-IDF ---------------------------------------------------------------------

def _tfidf_sql(source, id, kind, most):
    return f"""f as (select {id} as id, {tokens('text', kind)} as w from {source}),
    k as (select id, unnest(w) as t, generate_subscripts(w, 1) as i from f),
    b as (select id, t, t || ' ' || lead(t) over (partition by id order by i) as tt from k),
    g as (select id, t as term from b union all select id, tt from b where tt is not null),
    c as (select id, term, count(*) as tf from g group by all),
    v as (select term, sum(tf) as cf, ln((1 + (select count(*) from f)) / (1 + count(*))) + 1 as idf from c group by term order by cf desc, term limit {most}),
    x as (select id, term, tf * idf as w from c join v using (term)),
    n as (select id, term, w / sqrt(sum(w * w) over (partition by id)) as w from x),
    d as (select a.id as i, b.id as j, sum(a.w * b.w) as s from n a join n b on a.term = b.term and a.id < b.id group by all),
    p as (select least(1, coalesce(s, 0)) as s from f a join f b on a.id < b.id left join d on d.i = a.id and d.j = b.id)"""


@query(f"with {_tfidf_sql('benchmark', 'item_id', 'term', 10000)} select {_STATS} from p")
def tfidf_pair_stats(spark, d):
    return rounded(tf.tfidf_pair_stats(table(spark, d, "benchmark"), "text", "item_id"))


@query(f"with {_tfidf_sql('documents', 'doc_id', 'term2', 10000)} select {_STATS} from p")
def tfidf_documents(spark, d):
    return rounded(tf.tfidf_pair_stats(table(spark, d, "documents"), "text", "doc_id", kind="term2"))


@query(f"with {_tfidf_sql('documents', 'doc_id', 'term2', 10000)} select {_SHARES} from p")
def tfidf_shares(spark, d):
    """Shares of pairs above thresholds by the threshold join."""
    rows = tf.tfidf(table(spark, d, "documents"), "text", "doc_id", kind="term2")
    found = threshold.sparse_shares_above(rows, "doc_id", "places", "weights")
    return found.select("n_pairs", *[F.round(c, 9).alias(c) for c in similarity.SHARES])


@query(f"with {_tfidf_sql('documents', 'doc_id', 'term2', 10000)} select i, j, round(least(1, s), 6) as score from d where s > 0.7")
def tfidf_close_pairs(spark, d):
    rows = tf.tfidf(table(spark, d, "documents"), "text", "doc_id", kind="term2")
    return rounded(threshold.close_pairs(rows, "doc_id", "places", "weights", 0.7))


@query(f"with {_tfidf_sql('documents', 'doc_id', 'term', 10000)} select count(*) as n_pairs, round((select (power(sum(s), 1) - max(q)) from "
       f"(select power(sum(w), 2) as s, (select sum(w * w) from n) as q from n group by term)) / (2 * count(*)), 6) as mean from p")
def tfidf_mean(spark, d):
    rows = tf.tfidf(table(spark, d, "documents"), "text", "doc_id")
    return rounded(tf.tfidf_mean_cosine(rows))


@query("with " + _tfidf_sql("documents", "doc_id", "term", 10000).replace("as id, ", "as id, lang, ", 1).replace("unnest(w)", "lang, unnest(w)").replace(
    "select id, t, t ||", "select id, lang, t, t ||").replace("select id, t as term", "select id, lang, t as term").replace("select id, tt", "select id, lang, tt").replace(
    "select id, term, count(*)", "select id, lang, term, count(*)").replace("select term, sum(tf) as cf, ln((1 + (select count(*) from f))",
    "select lang, term, sum(tf) as cf, ln((1 + (select count(*) from f f2 where f2.lang = c.lang))").replace("group by term order by cf desc, term limit 10000",
    "group by lang, term qualify row_number() over (partition by lang order by cf desc, term) <= 10000").replace("using (term)", "using (lang, term)").replace(
    "a.id < b.id left", "a.id < b.id and a.lang = b.lang left").replace("coalesce(s, 0)) as s", "coalesce(s, 0)) as s, a.lang") + f" select lang, {_STATS} from p group by lang")
def tfidf_by_lang(spark, d):
    return rounded(tf.tfidf_pair_stats(table(spark, d, "documents"), "text", "doc_id", ["lang"]))


# ---- retrieval -------------------------------------------------------------------

@query("""with q as (select a.vec_id as query, b.vec_id as id, round(greatest(-1, least(1, list_inner_product(a.embedding::double[], b.embedding::double[]))), 9) as score
    from embeddings a join embeddings b on a.vec_id % 25 = 0 and a.vec_id <> b.vec_id),
  r as (select *, row_number() over (partition by query order by score desc, id) as rank from q)
  select query, rank, id, round(score, 6) as score, source, replace(substr(text, 1, 80), chr(10), ' | ') as passage from r left join documents on doc_id = id where rank <= 5""")
def retrieve_passages(spark, d):
    """The five nearest passages of some vectors with their sources; all lists are asked, so the answer is exact."""
    rows = embeddings(spark, d)
    index = retrieval.vector_index(rows, "vec_id", "embedding", 16)
    found = retrieval.search(index, rows.filter("vec_id % 25 = 0"), "vec_id", "embedding", 5, skip_same=True)
    return rounded(retrieval.with_sources(found, table(spark, d, "documents"), "doc_id", "text", "source", 80))


@query()
def retrieve_recall(spark, d):
    """What asking a quarter, a half and all of the lists finds of the exact answers."""
    rows = embeddings(spark, d)
    index, some = retrieval.vector_index(rows, "vec_id", "embedding", 16), rows.filter("vec_id % 25 = 0")
    exact = retrieval.search(index, some, "vec_id", "embedding", 5, skip_same=True)
    parts = [retrieval.recall(retrieval.search(index, some, "vec_id", "embedding", 5, p, skip_same=True), exact).select(F.lit(p).alias("probes"), "*") for p in (4, 8, 16)]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))
