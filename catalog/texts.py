"""Text and metadata functions over the document table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import meta, text as t

from .common import (
    BULLETS, ENGLISH, MARKED, PIPE, RAW, SPACE, SPACES, WORD, digest, documents, first_line, fold, normal_form, strip,
    tokens,
)

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f
    return add


M = f"(select doc_id, {MARKED} as s from documents)"


@query(f"""select doc_id, {fold('s')} as folded,
  translate(s, '0123456789', '০১২৩৪৫৬৭৮৯') as bengali, {first_line('s')} as line from {M}""")
def digits_and_lines(spark, d):
    return documents(spark, d, s=MARKED).select(
        "doc_id", t.normalize_digits("s").alias("folded"), t.numerals("s", "bengali").alias("bengali"),
        t.first_line("s").alias("line"))


@query("select doc_id, " + ", ".join(
    f"len({tokens('s', k)}) as n_{k}, list_distinct({tokens('s', k)}).len() as u_{k}, array_to_string({tokens('s', k)}[-3:], ' ') as last_{k}"
    for k in ("bn", "word", "ascii", "term", "term2")) + f", len(regexp_extract_all(s, '[^{SPACES}]+')) as n_space from {M}")
def token_kinds(spark, d):
    rows = documents(spark, d, s=MARKED)
    columns = []
    for k in ("bn", "word", "ascii", "term", "term2"):
        found = t.tokens("s", k)
        tail = F.slice(found, F.greatest(F.size(found) - 2, F.lit(1)), F.lit(3))
        columns += [F.size(found).alias(f"n_{k}"), F.size(F.array_distinct(found)).alias(f"u_{k}"),
                    F.array_join(tail, " ").alias(f"last_{k}")]
    return rows.select("doc_id", *columns, F.size(t.tokens("s", "space")).alias("n_space"))


@query(f"""select doc_id, {normal_form('s', 'word')} as word_form, {normal_form('s')} as bn_form,
  {digest(normal_form('s'))} as content_hash from {M}""")
def normal_forms(spark, d):
    return documents(spark, d, s=MARKED).select(
        "doc_id", t.hash_normalize("s", "word").alias("word_form"), t.hash_normalize("s", "bn").alias("bn_form"),
        t.content_hash("s").alias("content_hash"))


def _layout(x):
    fences = f"regexp_replace({x}, '(?m)^{SPACE}*```.*$', ' ', 'g')"
    return f"regexp_replace({fences}, '(?m)^[{SPACES}_\\-=|]+$', ' ', 'g')"


_DEVA = r"[\x{0900}-\x{0939}\x{093E}-\x{094D}\x{0950}-\x{0954}\x{0960}-\x{0963}]"
_BENG = r"[\x{0980}-\x{09ff}]"


@query(f"""select doc_id, {_layout('s')} as plain, regexp_matches({_layout('s')}, '[£€¥©®]') as garbage,
  regexp_matches(regexp_replace({_layout('s')}, '[।॥]+', '', 'g'), '{_BENG}{_DEVA}|{_DEVA}{_BENG}') as mixed from {M}""")
def garbled(spark, d):
    return documents(spark, d, s=MARKED).select(
        "doc_id", t.strip_layout("s").alias("plain"), t.has_garbage("s").alias("garbage"),
        t.has_mixed_script("s").alias("mixed"))


@query(f"""with f as (select doc_id, s, regexp_matches(s, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]') as control,
    regexp_matches(s, '\\${SPACE}*[\\t\\r\\f\\x0B]+') as math, (length(s) - length(replace(s, '$', ''))) % 2 <> 0 as odd from {M})
  select doc_id, control, math, odd, array_to_string(list_filter([
    case when control then 'illegal control character' end,
    case when math then 'corrupted math expression after dollar sign' end,
    case when odd then 'unbalanced dollar math delimiter' end], lambda x: x is not null), '; ') as issues,
    regexp_replace(s, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g') as clean from f""")
def text_issues(spark, d):
    return documents(spark, d, s=MARKED).select(
        "doc_id", t.has_control("s").alias("control"), t.has_corrupt_math("s").alias("math"),
        t.has_odd_dollars("s").alias("odd"), t.text_issues("s").alias("issues"), t.drop_control("s").alias("clean"))


R = f"(select doc_id, {RAW} as s from documents)"
_ANSWER = f"(?s)উত্তর{SPACE}*[:：](.*)"


@query(f"""select doc_id, {strip(f"regexp_replace({fold(first_line('s'))}, '[0-9]+', '#', 'g')")} as template,
  {strip(f"regexp_replace({first_line('s')}, '^{SPACE}*প্রশ্ন{SPACE}*[:：]{SPACE}*', '')")} as question,
  {strip(f"case when regexp_matches(s, '{_ANSWER}') then regexp_extract(s, '{_ANSWER}', 1) else s end")} as answer from {R}""")
def question_answer(spark, d):
    return documents(spark, d, s=RAW).select(
        "doc_id", t.template("s").alias("template"), t.split_question("s").alias("question"),
        t.split_answer("s").alias("answer"))


_FINAL = f"(?s)চূ(?:ড়|ড়)ান্ত উত্তর[:：]?{SPACE}*(.+)"


@query(f"""with a as (select doc_id, s, regexp_extract({fold('s')}, '-?[0-9]+\\.?[0-9]*') as n,
    {first_line(strip(f"coalesce(nullif(regexp_extract(s, '{_FINAL}', 1), ''), s)"))} as final_answer from {M})
  select doc_id, final_answer,
    try_cast(regexp_extract_all({fold("replace(s, ',', '')")}, '-?[0-9]+(?:\\.[0-9]+)?')[-1] as double) as last_number,
    case when n <> '' then n else lower({strip(fold('s'))}) end as answer_key,
    nullif(regexp_extract(s, '(?:^|[^\\p{{L}}\\p{{N}}_])([A-D])(?:$|[^\\p{{L}}\\p{{N}}_])', 1), '') as choice,
    case when length({strip('s')}) <= 100 then {strip('s')} else substr({strip('s')}, 1, 100) || ' …[truncated]' end as short,
    replace(substr(s, 1, 200), chr(10), ' | ') as preview,
    greatest(1, cast(floor(length(s) / 3.5) as integer)) as est_tokens from a""")
def answers(spark, d):
    return documents(spark, d, s=MARKED).select(
        "doc_id", t.final_answer("s").alias("final_answer"), t.last_number("s").alias("last_number"),
        t.answer_key("s").alias("answer_key"), t.choice_letter("s").alias("choice"), t.truncate("s", 100).alias("short"),
        t.preview("s", 200).alias("preview"), t.token_estimate("s", 3.5).alias("est_tokens"))


_LAST = f"regexp_extract(w[i], '{WORD}+$')"


@query(f"""select doc_id, {strip('s')} = '' or len(list_filter(range(1, greatest(1, len(w) - 2)), lambda i: {_LAST} <> '' and w[i + 1] = {_LAST}
    and w[i + 2] = w[i + 1] and starts_with(w[i + 3], w[i + 1]))) > 0 as degenerate
  from (select doc_id, s, string_split(lower(s), ' ') as w from (select doc_id, {MARKED} as s from documents))""")
def degenerate(spark, d):
    return documents(spark, d, s=MARKED).select("doc_id", t.is_degenerate("s").alias("degenerate"))


# ---- metadata -----------------------------------------------------------------

E = f"(select doc_id, {ENGLISH} as s from documents)"


def _field(name):
    raw = f"regexp_extract(s, '(?i){name}:{SPACE}*([^|\\n]+)', 1)"
    return f"case when {raw} = '' then 'UNKNOWN' else {strip(raw)} end"


_TOPIC = f"(?s)topic:{SPACE}*(.*?){SPACE}*\\nstate:"


@query(f"""select doc_id, {_field('grade')} as grade, {_field('subject')} as subject, {_field('district')} as district,
  {_field('terrain')} as terrain, {_field('setting')} as setting,
  case when regexp_matches(s, '{_TOPIC}') then {strip(f"regexp_extract(s, '{_TOPIC}', 1)")} else {_field('topic')} end as topic,
  case when contains(s, chr(10) || 'CONTEXT' || chr(10)) then substr(s, instr(s, chr(10) || 'CONTEXT' || chr(10)) + 9)
    when contains(s, 'CONTEXT') then split_part(s, 'CONTEXT', -1) else s end as block from {E}""")
def meta_english(spark, d):
    fields = ("grade", "subject", "district", "terrain", "setting")
    return documents(spark, d, s=ENGLISH).select(
        "doc_id", *[meta.context_field("s", f).alias(f) for f in fields],
        meta.context_topic("s").alias("topic"), t.context_block("s").alias("block"))


_DISTRICT = ("জেলা", "অঞ্চল/জেলা", "অঞ্চল")
_CLASS = ("শ্রেণী", "শ্রেণি")
_SUBJECT = ("বিষয়", "বিষয়")
_CHAPTER = ("পাঠ্য অধ্যায়", "পাঠ্য অধ্যায়", "বিষয়বস্তু", "বিষয়বস্তু", "Topic", "Chapter")


def _block_field(block, labels):
    tries = []
    for label in labels:
        for stop in (r"([^|\]]+)", r"([^\n|]+)"):
            line = strip(first_line(strip(f"regexp_extract({block}, '{label}{SPACE}*:{SPACE}*{stop}', 1)")))
            tries.append(f"nullif({strip(f'ltrim({line}, {chr(39)}- {chr(39)})')}, '')")
        bullet = f"regexp_extract({block}, '-{SPACE}*{label}{SPACE}*:{SPACE}*(.+)', 1)"
        tries.append(f"nullif({strip(first_line(strip(bullet)))}, '')")
    return f"coalesce({', '.join(tries)}, 'UNKNOWN')"


_NAMES = (("গণিত", "Mathematics"), ("ভূগোল", "Geography"), ("বিজ্ঞান", "Science"), ("জীবন বিজ্ঞান", "Biology"),
          ("অর্থনীতি", "Economics"), ("সমাজবিজ্ঞান", "Social Science"), ("রসায়ন", "Chemistry"),
          ("ভৌত বিজ্ঞান", "Physics"), ("EVS", "EVS"))
_SPELLED = {"১০ম": "10", "দশম": "10"}


def _meta_oracle(source):
    block = "(case when contains(s, 'metadata:') then substr(s, instr(s, 'metadata:') + 9) else s end)"
    names = " ".join(f"when contains(replace(subject, 'য়', 'য়'), '{w}') then '{n}'" for w, n in _NAMES)
    classes = " ".join(f"when class = '{w}' then '{n}'" for w, n in _SPELLED.items())
    return f"""with p as (select doc_id, {_block_field(block, _DISTRICT)} as district, {_block_field(block, _CLASS)} as class,
      {_block_field(block, _SUBJECT)} as subject, {_block_field(block, _CHAPTER)} as chapter from (select doc_id, {source} as s from documents))
    select doc_id, district, class, subject, chapter,
      case when regexp_extract(subject, '\\(([^)]+)\\)', 1) <> '' then {strip("regexp_extract(subject, '\\(([^)]+)\\)', 1)")} {names}
        else {strip('subject')} end as subject_norm,
      case {classes} when regexp_extract({fold('class')}, '[0-9]+') <> '' then regexp_extract({fold('class')}, '[0-9]+') else class end as class_norm
    from p"""


def _meta_query(spark, d, source):
    parsed = documents(spark, d, s=source).select("doc_id", meta.parse_meta("s").alias("m")).select("doc_id", "m.*")
    return parsed.select("*", meta.subject_norm("subject").alias("subject_norm"), meta.class_norm("class").alias("class_norm"))


@query(_meta_oracle(PIPE))
def meta_pipe(spark, d):
    return _meta_query(spark, d, PIPE)


@query(_meta_oracle(BULLETS))
def meta_bullets(spark, d):
    return _meta_query(spark, d, BULLETS)


def _bullet(block, labels):
    tries = []
    for label in labels:
        raw = f"regexp_extract({block}, '- {label}{SPACE}*:{SPACE}*([^\\n]+)', 1)"
        tries.append(f"case when {raw} <> '' then {strip(raw)} end")
    return f"coalesce({', '.join(tries)}, 'UNKNOWN')"


@query(f"""with b as (select doc_id, case when instr(s, 'পাঠ্যসূচি বিবরণী') > 0 then substr(s, instr(s, 'পাঠ্যসূচি বিবরণী'), 900)
    else right(s, 900) end as block from (select doc_id, {BULLETS} as s from documents union all select doc_id + 1000000000, {PIPE} from documents))
  select doc_id, {_bullet('block', _SUBJECT)} as subject, lower({strip(_bullet('block', _SUBJECT))}) as subject_norm,
    {_bullet('block', tuple(reversed(_CLASS)))} as class from b""")
def meta_curriculum(spark, d):
    bullets = documents(spark, d, s=BULLETS).select("doc_id", "s")
    pipes = documents(spark, d, s=PIPE).select(F.col("doc_id") + 1000000000, "s")
    return bullets.union(pipes).select("doc_id", meta.parse_curriculum("s").alias("m")).select("doc_id", "m.*")


def _line(name, aliases):
    tries = []
    for alias in aliases:
        inline = f"(?i){alias}{SPACE}*:{SPACE}*(.*?)(?:{SPACE}*\\||{SPACE}*\\z|\\n)"
        bullet = f"(?im)^{SPACE}*-{SPACE}*{alias}{SPACE}*:{SPACE}*(.+?){SPACE}*$"
        tries += [f"nullif({strip(f'regexp_extract(block, {chr(39)}{p}{chr(39)}, 1)')}, '')" for p in (inline, bullet)]
    return f"'{name}: ' || coalesce({', '.join(tries)})"


_BLOCK = f"(?is)(?:\\[|\\n){SPACE}*[^\\]\\n]*metadata{SPACE}*:{SPACE}*(.*?)(?:\\]|\\n{SPACE}*\\n|\\z)"


@query(f"""with b as (select doc_id, case when regexp_matches(s, '{_BLOCK}') then regexp_extract(s, '{_BLOCK}', 1) else s end as block
    from (select doc_id, {PIPE} as s from documents union all select doc_id + 1000000000, {BULLETS} from documents))
  select doc_id, array_to_string(list_filter([{_line('জেলা', _DISTRICT[:1])}, {_line('শ্রেণী', _CLASS)},
    {_line('বিষ' + chr(0x9af) + chr(0x9bc), _SUBJECT)}, {_line('পাঠ্য অধ্যা' + chr(0x9af) + chr(0x9bc), _CHAPTER)}],
    lambda x: x is not null), chr(10)) as context from b""")
def meta_context(spark, d):
    pipes = documents(spark, d, s=PIPE).select("doc_id", "s")
    bullets = documents(spark, d, s=BULLETS).select(F.col("doc_id") + 1000000000, "s")
    return pipes.union(bullets).select("doc_id", meta.judge_context("s").alias("context"))
