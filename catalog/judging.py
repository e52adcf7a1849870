"""Splits, answer metrics, prompts, verdicts and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import scores, text as t
from sievework.operators import cluster, dedup, requests, split, verdicts
from sievework.functions.stems import porter_stems
from sievework.operators.ordering import hash_key, shuffled, with_position
from sievework.plans import scoring
from sievework.session import checkpointed

from .common import RAW, SPACE, SPACES, WORD, documents, first_line, fold, hashed, quoted, strip, table, tokens
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


# ---- preparing sets -------------------------------------------------------------

_TEMPLATE = strip(f"regexp_replace({fold(first_line('s'))}, '[0-9]+', '#', 'g')")
_ANSWER = f"(?s)উত্তর{SPACE}*[:：](.*)"
_SPLIT = f"""with r as (select doc_id, lang, source, {RAW} as s from documents), t as (select *, {_TEMPLATE} as template from r),
  d as (select template, count(*) as n from t group by template),
  h as (select template, n, row_number() over (order by {hashed(42, 'template')}, template) <= greatest(1, floor((select count(*) from d) * 0.15)) as held from d),
  k as (select t.*, held, row_number() over (partition by template order by {hashed(42, 'doc_id')}, doc_id) as r from t join h using (template)),
  b as (select doc_id, lang, template, case when held then 'eval' else 'train' end as side,
    translate(s, '0123456789', '০১২৩৪৫৬৭৮৯') as s from k where r <= case when held then 3 else 4 end),
  q as (select doc_id, lang, template, side, {strip(f"regexp_replace({first_line('s')}, '^{SPACE}*প্রশ্ন{SPACE}*[:：]{SPACE}*', '')")} as question,
    {strip(f"case when regexp_matches(s, '{_ANSWER}') then regexp_extract(s, '{_ANSWER}', 1) else s end")} as answer from b)"""


def raw_rows(spark, d):
    rows = documents(spark, d, s=RAW)
    return rows.select("doc_id", F.col("s").alias("text"), F.lit(None).cast("string").alias("band"), F.col("lang").alias("subject"), F.col("source").alias("topic"))


@query(_SPLIT + " select doc_id, lang as subject, side, template, question, answer, 3 as n from q")
def template_split(spark, d):
    rows = split.template_split(raw_rows(spark, d), "doc_id")
    return rows.select(
        "doc_id", "subject", "side", "template", F.col("messages")[1]["content"].alias("question"),
        F.col("messages")[2]["content"].alias("answer"), F.size("messages").alias("n"))


@query(_SPLIT + " select template, n as rows, case when held then 'eval' else 'train' end as side from h")
def template_sides(spark, d):
    return split.template_sides(raw_rows(spark, d))


@query(f"""select doc_id, template from (select doc_id, {_TEMPLATE} as template, row_number() over (partition by {_TEMPLATE}
  order by {hashed(7, 'doc_id')}, doc_id) as r from (select doc_id, {RAW} as s from documents)) where r <= 2""")
def template_cap(spark, d):
    rows = documents(spark, d, s=RAW).select("doc_id", t.template("s").alias("template"))
    return dedup.cap_per_key(rows, "template", 2, 7, "doc_id")


_PERSONA = [("who are you?", "a teaching helper"), ("which language?", "Bengali, mostly")]


@query(_SPLIT + f""", o as (select {strip("regexp_replace(translate('প্রশ্ন: ' || question, '০১২৩৪৫৬৭৮৯', '0123456789'), '[0-9]+', '#', 'g')")} as t, side from q)
  select count(*) filter (side = 'train') + 6 as train_rows, 6 as identity_rows, count(*) filter (side = 'eval') as eval_rows,
    (select count(*) from h) as templates, (select count(*) from h where not held) as train_templates,
    (select count(*) from h where held) as eval_templates,
    (select count(*) from (select t from o where side = 'train' intersect select t from o where side = 'eval')) as template_overlap from q""")
def data_card(spark, d):
    rows = split.template_split(raw_rows(spark, d), "doc_id")
    records = rows.unionByName(split.identity_rows(spark, _PERSONA), allowMissingColumns=True)
    return split.data_card(records, split.template_sides(raw_rows(spark, d)))


def _mix(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return split.mix_general(docs.filter("lang = 'en'"), docs.filter("lang <> 'en'"), "doc_id", 0.25)


_MIX = f"""with s as (select count(*) as n from documents where lang = 'en'),
  g as (select *, row_number() over (order by {hashed(42, 'doc_id')}, doc_id) as r from documents where lang <> 'en'),
  m as (select doc_id, lang, false as general from documents where lang = 'en' union all
    select doc_id, lang, true from g where r <= (select round_even(n / 3.0, 0) from s))"""


@query(_MIX + " select * from m")
def mix_general(spark, d):
    return _mix(spark, d).select("doc_id", "lang", "general")


@query(_MIX + """ select count(*) filter (not general) as sft, count(*) filter (general) as general_used, count(*) as total,
  round(count(*) filter (general) / count(*), 6) as share, count(*) filter (general) < (select round_even(n / 3.0, 0) from s) as short from m""")
def mix_report(spark, d):
    return rounded(split.mix_report(_mix(spark, d), 0.25))


@query(f"""select doc_id, case when row_number() over (order by {hashed(3407, 'doc_id')}, doc_id) <= ceil((select count(*) from documents) * 0.5)
  then 'test' else 'train' end as side from documents""")
def half_split(spark, d):
    return split.share_split(table(spark, d, "documents").select("doc_id"), "doc_id")


@query("select doc_id, row_number() over (order by doc_id) - 1 as position, (row_number() over (order by doc_id) - 1) // 4 as batch from documents")
def batch_numbers(spark, d):
    placed = with_position(table(spark, d, "documents").select("doc_id"), "doc_id")
    return placed.withColumn("batch", F.floor(F.col("position") / 4))


@query(f"select conv_id, turn, {hashed(5, chr(34) + 'conv_id' + chr(34) + ', ' + chr(39) + '|' + chr(39) + ', turn')} as h from conversations")
def seeded_shuffle(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn")
    return shuffled(rows, 5, "conv_id", "turn").withColumn("h", hash_key(5, "conv_id", "turn"))


# ---- answers against references ---------------------------------------------------

# Question, reference and two answers from the documents: one answer is a part of
# the reference with words in another order, the other is mostly the next text.
BASE = "concat(substr(text, 1 + length(text) div 3), ' ', substr(text, 1, length(text) div 3), ' B ', doc_id)"
SFT = "concat(substr(text, 1, 5 * length(text) div 6), ' A ', case when doc_id % 3 = 0 then doc_id else doc_id * 1.004 end)"
REF = "concat(text, ' ', case when doc_id % 5 = 0 then '' else 'A ' end, case when doc_id % 7 = 0 then '' else concat('1,', doc_id % 10, '00') end)"
TASK = "case doc_id % 4 when 0 then 'numerical' when 1 then 'mcq' when 2 then 'Practice_Question' else 'essay' end"


def triples(spark, d):
    return documents(spark, d, reference_answer=REF, base_answer=BASE, sft_answer=SFT, task_type=TASK)


def _triples_sql():
    return "(select doc_id, {} as ref, {} as base, {} as sft, {} as task from documents)".format(
        *[x.replace(" div ", " // ") for x in (REF, BASE, SFT, TASK)])


_TRIPLES = _triples_sql()


def _gram_sql(ref, hyp, longest):
    """Clipped overlaps of token lists: c(doc_id, n, m, r, h)."""
    def side(name, expr):
        spread = f"select doc_id, unnest({expr}) as t, generate_subscripts({expr}, 1) as i from x"
        shifts = ", ".join(f"lead(t, {k}) over (partition by doc_id order by i) as t{k}" for k in range(1, longest))
        rows = " union all ".join(
            f"select doc_id, {n} as n, {' || chr(1) || '.join(['t'] + [f't{k}' for k in range(1, n)])} as g from {name}2" for n in range(1, longest + 1))
        return (f"{name}1 as ({spread}), {name}2 as (select *{', ' + shifts if shifts else ''} from {name}1), "
                f"{name} as (select doc_id, n, g, count(*) as c from ({rows}) where g is not null group by all)")
    return f"""{side('gr', ref)}, {side('gh', hyp)},
      c as (select doc_id, n, sum(least(coalesce(a.c, 0), coalesce(b.c, 0))) as m, sum(coalesce(a.c, 0)) as r, sum(coalesce(b.c, 0)) as h
        from gr a full join gh b using (doc_id, n, g) group by all)"""


@query(f"""with x as (select doc_id, {tokens('ref', 'ascii')} as rt, {tokens('sft', 'ascii')} as ht from {_TRIPLES}), {_gram_sql('rt', 'ht', 2)},
  f as (select doc_id, n, case when m > 0 then 2 * m / (r + h) else 0 end as f from c)
  select doc_id, round(coalesce(max(f) filter (n = 1), 0), 6) as rouge1, round(coalesce(max(f) filter (n = 2), 0), 6) as rouge2
  from {_TRIPLES} left join f using (doc_id) group by doc_id""")
def rouge_scores(spark, d):
    return rounded(triples(spark, d).select("doc_id", scores.rouge("reference_answer", "sft_answer").alias("r")).select(
        "doc_id", "r.rouge1", "r.rouge2"))


@query()
def rouge_l(spark, d):
    return rounded(triples(spark, d).select("doc_id", scores.rouge("reference_answer", "base_answer").alias("r")).select(
        "doc_id", "r.rougeL"))


@query()
def rouge_stemmed(spark, d):
    found = scores.rouge("reference_answer", "sft_answer", stemmer=porter_stems)
    return rounded(checkpointed(triples(spark, d).select("doc_id", found.alias("r")), scores.BATCH_ROWS).select("doc_id", "r.*"))


@query()
def score_answers(spark, d):
    return rounded(scoring.score_answers(triples(spark, d).withColumnRenamed("doc_id", "id")))


def _mteval(x):
    s = f"' ' || replace(replace(replace(replace(replace(replace(replace({x}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' '), '&quot;', '\"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>') || ' '"
    for p, r in ((r"([\{-\~\[-\x60 -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
                 (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")):
        s = f"regexp_replace({s}, '{p}', '{r}', 'g')"
    return f"regexp_extract_all({s}, '[^{SPACES}]+')"


@query(f"""with x as (select doc_id, {_mteval('ref')} as rt, {_mteval('sft')} as ht from {_TRIPLES}), {_gram_sql('rt', 'ht', 4)},
  p as (select *, sum((m = 0)::int) over (partition by doc_id order by n) as k from c where h > 0),
  l as (select doc_id, sum(ln(case when m = 0 then 1 / (pow(2, k) * h) else m / h end)) as s, count(*) as o, max(r) filter (n = 1) as r, max(h) filter (n = 1) as h, max(m) as best from p group by doc_id)
  select doc_id, round(case when best > 0 then case when h < r then exp(1 - r / h) else 1 end * exp(s / o) else 0 end, 6) as bleu from l""")
def bleu(spark, d):
    return rounded(triples(spark, d).select("doc_id", scores.bleu("reference_answer", "sft_answer").alias("bleu")))


@query(f"""with x as (select doc_id, string_split(regexp_replace(ref, '{SPACE}+', '', 'g'), '') as rt, string_split(regexp_replace(sft, '{SPACE}+', '', 'g'), '') as ht from {_TRIPLES}),
  {_gram_sql('rt', 'ht', 6)}, a as (select doc_id, avg(m / h) as p, avg(m / r) as q from c where h > 0 and r > 0 group by doc_id)
  select doc_id, round(case when p + q > 0 then 5 * p * q / (4 * p + q) else 0 end, 6) as chrf from a""")
def chrf(spark, d):
    return rounded(triples(spark, d).select("doc_id", scores.chrf("reference_answer", "sft_answer").alias("chrf")))


@query(f"""with x as (select doc_id, regexp_extract_all(lower(ref), '[^{SPACES}]+') as rt, regexp_extract_all(lower(sft), '[^{SPACES}]+') as ht from {_TRIPLES}),
  r1 as (select doc_id, unnest(rt) as t, generate_subscripts(rt, 1) as i from x), h1 as (select doc_id, unnest(ht) as t, generate_subscripts(ht, 1) as j from x),
  m as (select doc_id, i, j from (select *, row_number() over (partition by doc_id, t order by i desc) as k from r1)
    join (select *, row_number() over (partition by doc_id, t order by j desc) as k from h1) using (doc_id, t, k)),
  b as (select doc_id, i, j, lag(i) over w as pi, lag(j) over w as pj from m window w as (partition by doc_id order by j)),
  c as (select doc_id, count(*) as m, sum((pi is null or i <> pi + 1 or j <> pj + 1)::int) as chunks from b group by doc_id),
  s as (select doc_id, m, chunks, m / len(ht) as p, m / len(rt) as r from x join c using (doc_id))
  select doc_id, round(coalesce((1 - 0.5 * pow(chunks / m, 3)) * p * r / (0.9 * p + 0.1 * r), 0), 6) as meteor from x left join s using (doc_id)""")
def meteor_exact(spark, d):
    found = triples(spark, d).select("doc_id", scores.meteor_exact("reference_answer", "sft_answer").alias("meteor"))
    return rounded(checkpointed(found, scores.BATCH_ROWS))


def _last(x):
    digits = fold("replace({}, ',', '')".format(x))
    return f"try_cast(regexp_extract_all({digits}, '-?[0-9]+(?:\\.[0-9]+)?')[-1] as double)"


def _letter(x):
    return f"nullif(regexp_extract({x}, '(?:^|[^\\p{{L}}\\p{{N}}_])([A-D])(?:$|[^\\p{{L}}\\p{{N}}_])', 1), '')"


@query(f"""with v as (select doc_id, lower(task) as task, {_last('ref')} as rn, {_last('base')} as bn, {_last('sft')} as sn,
    {_letter('ref')} as rl, {_letter('base')} as bl, {_letter('sft')} as sl from {_TRIPLES}),
  m as (select *, task in ('numerical', 'mcq', 'practice_question') and rn is not null as num, task = 'mcq' and rl is not null as mcq from v)
  select doc_id, case when num then coalesce(abs(bn - rn) <= 0.01 * greatest(1, abs(rn)), false) end as num_match_base,
    case when num then coalesce(abs(sn - rn) <= 0.01 * greatest(1, abs(rn)), false) end as num_match_sft,
    case when mcq then coalesce(bl = rl, false) end as mcq_match_base, case when mcq then coalesce(sl = rl, false) end as mcq_match_sft from m""")
def answer_match(spark, d):
    return triples(spark, d).select(
        "doc_id",
        *[scores.number_match("task_type", "reference_answer", f"{s}_answer").alias(f"num_match_{s}") for s in ("base", "sft")],
        *[scores.choice_match("task_type", "reference_answer", f"{s}_answer").alias(f"mcq_match_{s}") for s in ("base", "sft")])


@query("""with v as (select doc_id, ((doc_id * 37) % 101) / 100.0::double as b, ((doc_id * 53) % 101) / 100.0::double as s, ((doc_id * 11) % 101) / 100.0::double as rb,
    ((doc_id * 29) % 101) / 100.0::double as rs from documents),
  c as (select doc_id, round(0.7 * b + 0.3 * rb, 9) as cb, round(0.7 * s + 0.3 * rs, 9) as cs from v)
  select doc_id, round(cb, 6) as base, round(cs, 6) as sft, round(cs - cb, 6) as delta,
    case when abs(round(cs - cb, 9)) < 0.02 then 'tie' when cs > cb then 'sft' else 'base' end as winner from c""")
def winners(spark, d):
    part = lambda k: F.expr(f"cast((doc_id * {k}) % 101 as double) / 100")
    rows = table(spark, d, "documents").select(
        "doc_id", F.round(scores.composite(part(37), part(11)), 9).alias("base"), F.round(scores.composite(part(53), part(29)), 9).alias("sft"))
    delta = F.round(F.col("sft") - F.col("base"), 9)
    return rounded(rows.withColumn("delta", delta).withColumn("winner", scores.winner(delta)))


@query(f"""with a as (select doc_id, concat('চূড়ান্ত উত্তর: ', doc_id % 6, chr(10), text) as p, concat(text, ' ', '৩') as g from documents)
  select count(*) as rows, count(*) filter ((doc_id % 6)::varchar = regexp_extract({fold(strip(first_line('g')))}, '-?[0-9]+\\.?[0-9]*')
    or (regexp_extract({fold(strip(first_line('g')))}, '-?[0-9]+\\.?[0-9]*') = '' and false)) as correct,
    round(avg(((doc_id % 6)::varchar = regexp_extract({fold(strip(first_line('g')))}, '-?[0-9]+\\.?[0-9]*'))::int), 6) as accuracy from a""")
def final_accuracy(spark, d):
    rows = table(spark, d, "documents").select(
        "doc_id", F.expr("concat('চূড়ান্ত উত্তর: ', doc_id % 6, chr(10), text)").alias("p"), F.expr("concat(text, ' ', '৩')").alias("g"))
    return rounded(verdicts.final_answer_accuracy(rows, "p", "g", "doc_id"))


@query("select doc_id, contains(text, 'the') as names_itself from documents")
def identity_check(spark, d):
    return table(spark, d, "documents").select("doc_id", F.contains("text", F.lit("the")).alias("names_itself"))


_COSINES = [[f"list_cosine_similarity(e[{i + 1}:{i + 16}], e[{j + 1}:{j + 16}])" for j in (32, 48)] for i in (0, 16)]
_RECALL = "(" + " + ".join(f"greatest({', '.join(row)})" for row in _COSINES) + ") / 2"
_PRECISION = "(" + " + ".join(f"greatest({_COSINES[0][j]}, {_COSINES[1][j]})" for j in (0, 1)) + ") / 2"


@query(f"""select vec_id, round(case when p + r <> 0 then 2 * p * r / (p + r) else 0 end, 6) as f1 from (
  select vec_id, {_PRECISION} as p, {_RECALL} as r from (select vec_id, embedding::double[] as e from embeddings))""")
def vector_f1(spark, d):
    rows = table(spark, d, "embeddings")
    halves = [F.array(F.slice("embedding", s, 16), F.slice("embedding", s + 16, 16)) for s in (1, 33)]
    return rounded(rows.select("vec_id", halves[0].alias("a"), halves[1].alias("b")).select(
        "vec_id", scores.vector_f1("a", "b").alias("f1")))


# ---- prompts and plans ------------------------------------------------------------

def parsed(spark, d):
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("row_id"), F.concat(F.lit("জেলা: "), "source").alias("context"), F.col("text").alias("question"),
        F.col("text").alias("answer"), F.when(F.col("doc_id") % 6 == 0, "unbalanced dollar math delimiter").otherwise("").alias("text_quality_issues"),
        F.expr("case when doc_id % 10 = 3 then 'missing user question' else '' end").alias("schema_issues"),
        (F.col("doc_id") % 10 != 3).alias("schema_valid"))


_ITEM = """chr(10) || '## item ' || doc_id || chr(10) || 'context: জেলা: ' || source || chr(10) || 'question: ' || text || chr(10) || 'answer: ' || text || chr(10)
  || 'known faults: ' || case when doc_id % 6 = 0 then 'unbalanced dollar math delimiter' else 'none' end || chr(10)"""
_BATCHES = f"""with i as (select doc_id, {_ITEM} as item, (row_number() over (order by doc_id) - 1) // 4 as batch from documents),
  b as (select batch, {quoted(requests.INSTRUCTION)} || string_agg(item, '' order by doc_id) as prompt, string_agg(doc_id::varchar, ',' order by doc_id) as ids
    from i group by batch)"""


@query(_BATCHES + " select * from b")
def judge_prompts(spark, d):
    prompts = requests.batch_prompts(parsed(spark, d))
    return prompts.select("batch", "prompt", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(_BATCHES + """, s as (select batch, greatest(1, floor(length(prompt) / 3.5))::bigint + 700 as tokens, batch // 50 as day from b),
  m as (select 20000 - coalesce(max(tokens) filter (tokens * 2 <= 20000), 0) as budget from s),
  c as (select s.*, budget, case when tokens * 2 <= 20000 then greatest(tokens, ceil(budget / 12)) else 0 end as cost from s, m),
  p as (select *, coalesce(sum(cost) over (partition by day order by batch rows between unbounded preceding and 1 preceding), 0) as paid from c)
  select batch, tokens, day, case when tokens * 2 <= 20000 then ceil(paid * 60 / budget * 1000) / 1000 end as start_second, tokens * 2 > 20000 as too_large from p""")
def batch_plan(spark, d):
    return requests.request_plan(requests.batch_prompts(parsed(spark, d)), tokens_per_minute=20_000, per_day=50)


@query("""select doc_id as id, 'user' as role, text as content, 'Q: ' || text || ' / ' || lang || ' ' as prompt from documents""")
def single_prompts(spark, d):
    rows = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), requests.question_messages("text").alias("m"), requests.fill("Q: {text} / {lang} {gone}", gone=F.lit(None)).alias("prompt"))
    return rows.select("id", F.col("m")[0]["role"].alias("role"), F.col("m")[0]["content"].alias("content"), "prompt")


# ---- replies and verdicts ---------------------------------------------------------

_REPLY = """concat('{"results": [{"id": ', case when doc_id % 19 = 1 then doc_id + 1 else doc_id end, ', "g": ', doc_id % 7 - 1, ', "f": "', doc_id % 5, '", "r": ',
  doc_id % 4, '.7, "i": ', case when doc_id % 23 = 2 then 'null' when doc_id % 23 = 3 then '"3.5"' else '4' end, ', "b": 3, "reason": " r', doc_id, ' "}',
  case when doc_id % 17 = 4 then concat(', {"id": ', doc_id, ', "g": 1, "f": 1, "r": 1, "i": 1, "b": 1, "reason": ""}') else '' end, ']}')"""


@query("""with r as (select doc_id, case when doc_id % 19 = 1 then doc_id + 1 else doc_id end as id, greatest(0, least(4, doc_id % 7 - 1))::int as g,
    (doc_id % 5)::int as f, (doc_id % 4)::int as r, case when doc_id % 23 in (2, 3) then null else 4 end::int as i, 3 as b, 'r' || doc_id as reason from documents)
  select doc_id, id, g, f, r, i, b, reason, case when doc_id % 29 = 5 then 'no list of results'
    when doc_id % 17 = 4 and id = doc_id then 'scored twice: ' || doc_id
    when doc_id % 17 = 4 then 'other ids than asked: missing [] extra [' || id || ']'
    when id <> doc_id then 'other ids than asked: missing [' || doc_id || '] extra [' || id || ']'
    when i is null then 'unusable score of ' || id end as error
  from r""".replace("select doc_id, id, g, f, r, i, b, reason, case", "select doc_id, " + ", ".join(
      f"case when doc_id % 29 <> 5 then {c} end as {c}" for c in ("id", "g", "f", "r", "i", "b", "reason")) + ", case"))
def verdict_parse(spark, d):
    replies = documents(spark, d, reply=_REPLY).select(
        "doc_id", F.array("doc_id").alias("ids"), F.expr("case when doc_id % 29 = 5 then '{\"results\": 3' else reply end").alias("reply"))
    first = verdicts.normalize_replies(replies).withColumn("one", F.get("results", F.lit(0)))
    return first.select("doc_id", "one.*", "error")


_SINGLE = """concat('{"groundedness": ', case when doc_id % 5 = 0 then 3 else 4 end, ', "faithfulness": 4, "hallucination": ', case when doc_id % 11 = 1 then '5' when doc_id % 11 = 2 then '3.5'
  when doc_id % 11 = 3 then '"4"' else '4' end, ', "bengali_quality": 4, "answer_relevancy": 4, "instruction_following": 4, "reason": "',
  case when doc_id % 5 = 0 and doc_id % 3 > 0 or doc_id % 13 = 0 then 'why' else '' end, '"}')"""


@query("""with r as (select doc_id, case when doc_id % 5 = 0 then 3 else 4 end as groundedness, case when doc_id % 11 in (1, 2, 3) then null else 4 end as hallucination,
    case when doc_id % 5 = 0 and doc_id % 3 > 0 or doc_id % 13 = 0 then 'why' else '' end as reason from documents)
  select doc_id, groundedness, hallucination, reason, round((groundedness + hallucination + 16) / 6, 2) as final_score,
    case when hallucination is null then 'unusable hallucination' when (groundedness = 4) <> (reason = '') then 'reason and scores disagree' end as violation from r""")
def verdict_accept(spark, d):
    replies = documents(spark, d, reply=_SINGLE).select("doc_id", "reply")
    return verdicts.accept_single(replies).select("doc_id", "groundedness", "hallucination", "reason", "final_score", "violation")


@query("""select coalesce(a.id, b.id) as id, coalesce(b.times, 0) as times, case when a.id is null then 'unexpected' when b.id is null then 'missing'
    when b.times > 1 then 'duplicate' else 'ok' end as status
  from (select doc_id as id from documents) a full join (select doc_id * 2 // 3 * 2 as id, count(*) as times from documents group by 1) b on a.id = b.id""")
def id_reconciliation(spark, d):
    docs = table(spark, d, "documents")
    return verdicts.reconcile_ids(docs.select(F.col("doc_id").alias("id")), docs.select(F.expr("(doc_id * 2 div 3) * 2").alias("id")))


_FIVE_SQL = ("case when doc_id % 31 = 0 then null else doc_id % 5 end::int as context_grounding, (doc_id // 2 % 5)::int as faithfulness, 4 as answer_relevancy, "
             "(2 + doc_id % 3)::int as instruction_following, 3 as bengali_language_quality")


def five_scores(spark, d):
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.expr("case when doc_id % 31 = 0 then null else cast(doc_id % 5 as int) end").alias("context_grounding"),
        F.expr("cast(doc_id div 2 % 5 as int)").alias("faithfulness"), F.lit(4).alias("answer_relevancy"),
        F.expr("cast(2 + doc_id % 3 as int)").alias("instruction_following"), F.lit(3).alias("bengali_language_quality"))


_FIVE_TOTAL = "context_grounding + faithfulness + answer_relevancy + instruction_following + bengali_language_quality"
_VERDICT = f"""with s as (select doc_id as row_id, {_FIVE_SQL} from documents), v as (select *, round(({_FIVE_TOTAL}) / 5, 2) as overall_score,
    coalesce(({_FIVE_TOTAL}) / 5 >= 3 and least(context_grounding, faithfulness, answer_relevancy, instruction_following, bengali_language_quality) >= 2
      and context_grounding is not null, false) as passed from s)"""


@query(_VERDICT + " select * from v")
def verdict_score(spark, d):
    return verdicts.with_verdict(five_scores(spark, d))


def final(spark, d):
    rows = parsed(spark, d)
    scored = verdicts.with_verdict(five_scores(spark, d)).withColumn("reason", F.lit("ok"))
    valid = scored.join(rows.filter("schema_valid").select("row_id"), "row_id", "left_semi").filter("row_id % 14 <> 1")
    return verdicts.final_report(rows, valid.unionByName(verdicts.schema_failed(rows)))


_FINAL = _VERDICT + f""", p as (select doc_id as row_id, doc_id % 10 <> 3 as schema_valid, case when doc_id % 10 = 3 then 'missing user question' else '' end as schema_issues,
    case when doc_id % 6 = 0 then 'unbalanced dollar math delimiter' else '' end as text_quality_issues, text as question, text as answer,
    'জেলা: ' || source as context from documents),
  r as (select row_id, {', '.join(verdicts.FIVE)}, overall_score, passed, 'ok' as reason from v where row_id % 10 <> 3 and row_id % 14 <> 1
    union all select row_id, null, null, null, null, null, null, false, 'schema_failed' from p where not schema_valid),
  final as (select {', '.join(verdicts.REPORT_COLUMNS)} from p left join r using (row_id))"""


@query(_FINAL + " select * from final")
def final_report(spark, d):
    return final(spark, d)


@query(_FINAL + """ select count(*) as rows, count(*) filter (coalesce(passed, false)) as passed, count(*) filter (not coalesce(passed, false)) as failed,
  count(*) filter (schema_valid) as schema_valid, count(*) filter (not schema_valid) as schema_invalid, count(*) filter (text_quality_issues <> '') as with_text_issues from final""")
def pass_counts(spark, d):
    return verdicts.pass_counts(final(spark, d))


# ---- six-dimension results ---------------------------------------------------------

def six_results(spark, d):
    docs = table(spark, d, "documents").withColumn("truncated", F.expr("case when doc_id % 9 = 0 then true when doc_id % 9 = 1 then null else false end"))
    auto = verdicts.auto_marked(docs.withColumnRenamed("doc_id", "id"))
    judged = verdicts.to_judge(docs).select(
        F.col("doc_id").alias("id"), *[F.expr(f"cast(case when doc_id % {p} = 0 then doc_id % 5 else 4 end as int)").alias(c) for c, p in zip(verdicts.SIX, (2, 3, 4, 5, 6, 7))])
    judged = judged.withColumn("reason", F.when(F.least(*verdicts.SIX) < 4, "low").otherwise(""))
    return judged.withColumn("final_score", verdicts.final_score(verdicts.SIX)).withColumn("judged", F.lit("llm")).unionByName(auto)


_SIX = f"""with a as (select doc_id as id, lang, doc_id % 9 = 0 as t, {', '.join(
    f"(case when doc_id % 9 = 0 then 0 when doc_id % {p} = 0 then doc_id % 5 else 4 end)::int as {c}" for c, p in zip(verdicts.SIX, (2, 3, 4, 5, 6, 7)))} from documents),
  six as (select id, {', '.join(verdicts.SIX)}, case when t then {quoted(verdicts.TRUNCATED)} when least({', '.join(verdicts.SIX)}) < 4 then 'low' else '' end as reason,
    round(({' + '.join(verdicts.SIX)}) / 6, 2) as final_score, case when t then 'auto' else 'llm' end as judged from a)"""


@query(_SIX + " select * from six")
def auto_mark(spark, d):
    return six_results(spark, d)


@query(_SIX + """ select count(*) as rows, count(*) - count(distinct id) as duplicate_ids, 0 as bad_scores, count(*) filter (id % 10 = 0 and final_score <> 1.5) as bad_final_scores,
  0 as bad_reasons, count(*) filter (id % 12 = 0) as bad_flags from six""")
def verdict_check(spark, d):
    damaged = six_results(spark, d).withColumn("final_score", F.when(F.col("id") % 10 == 0, 1.5).otherwise(F.col("final_score")))
    return verdicts.verdict_check(damaged.withColumn("judged", F.when(F.col("id") % 12 == 0, "me").otherwise(F.col("judged"))))


@query(_SIX + f""" select {', '.join(f'round(avg({c}), 3) as {c}_mean' for c in verdicts.SIX)}, round(avg(final_score), 3) as final_score_mean,
  count(*) filter (judged = 'llm') as n_llm, count(*) filter (judged = 'auto') as n_auto, count(*) filter (least({', '.join(verdicts.SIX)}) = 4) as perfect_rows,
  count(*) filter (reason <> '') as rows_with_reason from six""")
def judge_summary(spark, d):
    return verdicts.judge_summary(six_results(spark, d))


@query(_SIX + " select final_score, count(*) as count from six group by final_score")
def score_distribution(spark, d):
    return verdicts.score_distribution(six_results(spark, d))


@query(_SIX + " select lang, round(avg(final_score), 3) as mean, count(*) as rows from six join documents on doc_id = id group by lang")
def mean_by_subject(spark, d):
    langs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    return verdicts.mean_by(six_results(spark, d).join(langs, "id"), "lang")


@query("""select row_id, max(turn) as turn, arg_max(text, turn) as text from (select conv_id as row_id, turn, text from conversations) group by row_id""")
def keep_last(spark, d):
    return dedup.keep_last(table(spark, d, "conversations").select(F.col("conv_id").alias("row_id"), "turn", "text"), "row_id", "turn")


def _length_scorer(batch):
    """A stand-in scorer: fails on batches holding some ids, and always on others."""
    if len(batch) > 1 and any(r["doc_id"] % 21 == 0 for r in batch):
        raise ValueError("cannot score this batch")
    if any(r["doc_id"] % 50 == 7 for r in batch):
        raise ValueError("cannot score this row")
    return {r["doc_id"]: {"g": len(r["text"]) % 5, "f": r["doc_id"] % 5, "reason": f" {r['lang']} "} for r in batch}


@query("""select doc_id, case when doc_id % 50 <> 7 then length(text) % 5 end::int as g, case when doc_id % 50 <> 7 then doc_id % 5 end::int as f,
  case when doc_id % 50 = 7 then 'EVALUATION_ERROR: cannot score this row' else lang end as reason from documents""")
def scoring_adapter(spark, d):
    return requests.score_batches(table(spark, d, "documents").select("doc_id", "lang", "text"), _length_scorer, "doc_id", ["g", "f"])


# ---- clusters ----------------------------------------------------------------------

@query()
def kmeans_report(spark, d):
    return rounded(cluster.kmeans_report(table(spark, d, "embeddings"), "vec_id", "embedding"))


@query("""select k, count(*) as rows, count(*) as nearest from embeddings, (select unnest([10, 15, 20])::int as k) where (select count(*) from embeddings) >= 2 * k group by k""")
def kmeans_rows(spark, d):
    """Every row is in one cluster of each number of clusters, and no other centre is nearer: each row checked against all centres by column expressions."""
    rows = table(spark, d, "embeddings")
    models = cluster.kmeans(rows, "vec_id", "embedding", [k for k in (10, 15, 20) if rows.count() >= 2 * k], restarts=2)
    found = cluster.kmeans_clusters(rows, "vec_id", "embedding", models)
    centres = spark.createDataFrame([(k, c.tolist()) for k, (_, c) in models.items()], "k int, centres array<array<double>>")
    gap = lambda c: F.aggregate(F.zip_with("embedding", c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x)
    least = F.sqrt(F.array_min(F.transform("centres", gap)))
    met = found.join(rows, "vec_id").join(F.broadcast(centres), "k")
    return met.groupBy("k").agg(F.count("*").alias("rows"), F.count_if(F.abs(least - F.col("away")) < 1e-6).alias("nearest"))


@query()
def pca_2d(spark, d):
    return rounded(cluster.plane(table(spark, d, "embeddings"), "vec_id", "embedding"))
