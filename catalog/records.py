"""Chat records: reading, validation and exact deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import text as t
from sievework.operators import dedup, stats, validate
from sievework.plans import audit, cleaning, report
from sievework.session import new_folder
from sievework.sources import readers, writers
from sievework.streaming import incremental

from .common import BULLETS, MARKED, PIPE, documents, normal_form, strip, table
from .corpus import _view_sql, rounded
from .texts import _BENG, _DEVA, _bullet, _layout, _CLASS, _SUBJECT

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f
    return add


# Chat records made of the documents: some with too few messages, wrong roles,
# empty or damaged texts.
SYSTEM = f"case doc_id % 3 when 0 then {BULLETS} when 1 then {PIPE} else '' end"
USER = """case doc_id % 40 when 1 then '' when 2 then concat(' ', chr(10), chr(9)) when 3 then concat(text, ' £') when 4 then concat('কख ', text)
  when 5 then concat(replace(text, 'e', 'E'), ' !!') else text end"""
ASSISTANT = "case doc_id % 40 when 6 then '  ' when 7 then concat(text, ' ®') when 8 then concat(text, 'ম।न') else text end"
ROLE = "case when doc_id % 40 = 9 then 'tool' else 'user' end"
SIZE = "case when doc_id % 40 = 10 then 2 else 3 end"


def chats(spark, d):
    return as_chats(documents(spark, d))


def as_chats(docs):
    inputs = {"sys": SYSTEM, "usr": USER, "ast": ASSISTANT, "second": ROLE, "size": SIZE}
    rows = docs.select("doc_id", *[F.expr(sql).alias(name) for name, sql in inputs.items()])
    message = lambda role, content: F.struct(role.alias("role"), F.col(content).alias("content"))
    whole = F.array(message(F.lit("system"), "sys"), message(F.col("second"), "usr"), message(F.lit("assistant"), "ast"))
    return rows.select(F.col("doc_id").alias("id"), F.slice(whole, F.lit(1), F.col("size")).alias("messages"))


def _empty(x):
    return f"{strip(x)} = ''"


def _garbage(x):
    return f"regexp_matches({_layout(x)}, '[£€¥©®]')"


def _mixed(x):
    return f"regexp_matches(regexp_replace({_layout(x)}, '[।॥]+', '', 'g'), '{_BENG}{_DEVA}|{_DEVA}{_BENG}')"


def _validate_sql(records):
    """``records``: id, n, r1, r2, r3, sys, usr, ast."""
    return f"""with r as ({records}), f as (select *, case when n < 3 then 'schema: messages needs at least 3 items'
      when r1 <> 'system' or r2 <> 'user' or r3 <> 'assistant' then 'schema: first 3 roles must be [system, user, assistant]'
      when {_empty('usr')} then 'schema: empty user content' when {_empty('ast')} then 'schema: empty assistant content'
      when {_garbage('usr')} or {_garbage('ast')} then 'garbled: currency/copyright noise'
      when {_mixed('usr')} or {_mixed('ast')} then 'garbled: mixed_script Bengali+Devanagari' end as fault,
      substr(sha256({normal_form('usr')}), 1, 16) as h,
      case when instr(sys, 'পাঠ্যসূচি বিবরণী') > 0 then substr(sys, instr(sys, 'পাঠ্যসূচি বিবরণী'), 900) else right(sys, 900) end as block from r),
    v as (select *, min(case when fault is null then id end) over (partition by h) as first from f),
    validated as (select id, case when fault is not null then fault when id <> first then 'exact_dupe' end as reason,
      case when fault is null then h end as hash,
      case when fault is null or fault like 'garbled%' then lower({strip(_bullet('block', _SUBJECT))}) end as subject_norm,
      case when fault is null or fault like 'garbled%' then {_bullet('block', tuple(reversed(_CLASS)))} end as class from v)"""


_DOC_RECORDS = f"""select doc_id as id, {SIZE} as n, 'system' as r1, {ROLE} as r2, 'assistant' as r3, {SYSTEM} as sys, {USER} as usr,
  {ASSISTANT} as ast from documents"""
_CONV_RECORDS = """select conv_id as id, count(*) as n, max(case when turn = 0 then role end) as r1, max(case when turn = 1 then role end) as r2,
  max(case when turn = 2 then role end) as r3, max(case when turn = 0 then text end) as sys, max(case when turn = 1 then text end) as usr,
  max(case when turn = 2 then text end) as ast from conversations group by conv_id"""
VALIDATED = _validate_sql(_DOC_RECORDS)


def validated(spark, d):
    return validate.validate_records(chats(spark, d))


@query(VALIDATED + " select * from validated")
def record_validate(spark, d):
    return validated(spark, d).select(
        "id", "reason", "hash", F.col("meta.subject_norm").alias("subject_norm"), F.col("meta.class").alias("class"))


@query(_validate_sql(_CONV_RECORDS) + " select id, reason, hash from validated")
def chat_validate(spark, d):
    records = readers.assemble_chats(table(spark, d, "conversations"), "conv_id", "turn", "role", "text")
    return validate.validate_records(records).select("id", "reason", "hash")


@query(VALIDATED + """ select count(*) as total, count(*) filter (reason is null) as stage1_pass,
  count(*) filter (reason is not null) as stage1_quarantine, 0 as semantic_dropped, count(*) filter (reason is null) as final_clean,
  count(*) filter (reason is not null) as rejected_total, round(count(*) filter (reason is null) / count(*), 4) as stage1_pass_rate,
  round(count(*) filter (reason is null) / count(*), 4) as final_pass_rate from validated""")
def reject_report(spark, d):
    v = validated(spark, d)
    return validate.rejection_report(validate.passed(v), validate.quarantined(v)).drop("top_reasons")


@query(VALIDATED + """ select row_number() over (order by count desc, first) as rank, reason, count from (
  select reason, count(*) as count, min(id) as first from validated where reason is not null group by reason) order by rank limit 10""")
def top_reasons(spark, d):
    return validate.top_reasons(validate.quarantined(validated(spark, d)))


@query(VALIDATED + """ select count(*) filter (reason is null) as clean, count(*) filter (reason is not null) as rejected,
  count(*) as total, true as holds from validated""")
def partition_check(spark, d):
    v = validated(spark, d)
    return validate.partition_check(validate.passed(v), validate.quarantined(v), chats(spark, d))


@query(f"""select conv_id, turn, text from (select *, row_number() over (partition by {normal_form('text')} order by conv_id * 1000 + turn) as r
  from conversations where role = 'user') where r = 1""")
def exact_dedup_users(spark, d):
    users = table(spark, d, "conversations").filter("role = 'user'").withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    return dedup.exact_dedup(users, t.content_hash("text"), "id").select("conv_id", "turn", "text")


# ---- accumulating check ---------------------------------------------------------

_ABSENT = "doc_id % 40 = 11"


@query(f"""with r as (select doc_id, doc_id % 40 = 11 as absent, {SIZE} as n, case when doc_id % 40 = 9 then '' else {strip(USER)} end as q,
    {strip(ASSISTANT)} as a, {SYSTEM} as sys from documents),
  f as (select *, case when n < 3 then '' else a end as ans from r)
  select doc_id as row_id, case when absent then '' else q end as question, case when absent then '' else ans end as answer,
    case when absent then 'messages is missing or not a list' else array_to_string(list_filter([
      case when sys = '' then 'missing system message' end, case when q = '' then 'missing user question' end,
      case when ans = '' then 'missing assistant answer' end], lambda x: x is not null), '; ') end as schema_issues,
    case when absent or (length(ans) - length(replace(ans, '$', ''))) % 2 = 0 then '' else 'unbalanced dollar math delimiter' end as text_quality_issues,
    not absent and sys <> '' and q <> '' and ans <> '' as schema_valid from f""")
def parsed_rows(spark, d):
    rows = chats(spark, d).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 40 != 11, F.col("messages")).alias("messages"))
    return validate.parse_rows(rows).drop("context")


# ---- readers over lines that Spark derives --------------------------------------

@query("""select doc_id as id, case doc_id % 8 when 0 then 'bad_json' when 1 then 'not_object' when 2 then 'no_messages'
    when 3 then 'messages_not_list' when 4 then 'messages_not_list' end as fault,
  case when doc_id % 8 > 4 then 3 end as n, case when doc_id % 8 > 4 then text end as user_text,
  case doc_id % 8 when 0 then 'schema: json_decode_error' when 1 then 'schema: root object missing messages array'
    when 2 then 'schema: root object missing messages array' when 3 then 'schema: messages needs at least 3 items'
    when 4 then 'schema: messages needs at least 3 items' end as integrity,
  case doc_id % 8 when 0 then concat('Invalid JSONL at line ', doc_id + 1) when 1 then 'row is not a JSON object'
    when 2 then 'messages is missing or not a list' when 3 then 'messages is missing or not a list'
    when 4 then 'messages is missing or not a list' end as row_issue
  from documents where doc_id % 16 <> 13""")
def jsonl_lines(spark, d):
    docs = table(spark, d, "documents")
    turns = F.array(*[F.struct(F.lit(r).alias("role"), F.col("text").alias("content")) for r in validate.ROLES])
    good = F.to_json(F.struct(turns.alias("messages"), F.col("lang").alias("band")))
    lines = docs.select(F.col("doc_id").alias("id"), F.expr("doc_id % 8").alias("k"), "text", good.alias("good")).select(
        "id",
        F.when(F.col("id") % 16 == 13, "  ")
        .when(F.col("k") == 0, F.expr("substr(good, 1, length(good) - 3)"))
        .when(F.col("k") == 1, F.to_json(F.array("text")))
        .when(F.col("k") == 2, F.to_json(F.struct("text")))
        .when(F.col("k") == 3, F.to_json(F.struct(F.col("text").alias("messages"))))
        .when(F.col("k") == 4, '{"messages": null}')
        .otherwise(F.col("good")).alias("value"))
    parsed = readers.parse_chat_lines(lines)
    return parsed.select(
        "id", "fault", F.size("messages").alias("n"), F.get("messages", F.lit(1))["content"].alias("user_text"),
        readers.integrity_issue().alias("integrity"), readers.row_issue().alias("row_issue")
    ).withColumn("n", F.when(F.col("fault").isNull(), F.col("n")))


# ---- files that Spark writes and reads back -----------------------------------------

_KIND = "doc_id % 16"


def line_files(spark, d):
    """The documents as JSON Lines in id order, one line in 16 of each fault; the folder."""
    docs = table(spark, d, "documents")
    turns = F.array(*[F.struct(F.lit(r).alias("role"), F.col("text").alias("content")) for r in validate.ROLES])
    lines = docs.select("doc_id", "text", F.to_json(F.struct(turns.alias("messages"), F.col("lang").alias("band"))).alias("good")).select("doc_id", F.expr(f"""
        case {_KIND} when 0 then concat(good, ' trailing') when 1 then concat(good, ' ', good) when 2 then "{{'messages': []}}" when 3 then '   '
        when 4 then 'not json' when 5 then '["a"]' when 6 then '{{"band": "x"}}' when 7 then '{{"messages": "text"}}' when 8 then concat(good, ',')
        when 9 then '{{"messages": [{{"role": "user", "content": "one"}}]}}' else concat('  ', good, ' ') end""").alias("value"))
    folder = f"{new_folder(spark, 'lines')}/lines"
    lines.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(folder)
    return folder


_BAD = f"{_KIND} in (0, 1, 2, 4, 8)"


@query(f"""select doc_id as id, case when {_BAD} then 'schema: json_decode_error' when {_KIND} in (5, 6) then 'schema: root object missing messages array'
    when {_KIND} = 7 then 'schema: messages needs at least 3 items' end as load_issue, case when {_KIND} = 9 then 1 when {_KIND} > 9 then 3 end as n,
    case when {_KIND} > 9 then text end as user_text from documents where {_KIND} <> 3""")
def lines_quarantine(spark, d):
    rows = readers.read_jsonl_quarantine(spark, line_files(spark, d))
    return rows.select("id", "load_issue", F.when(F.col("messages").isNotNull(), F.size("messages")).alias("n"), F.get("messages", F.lit(1))["content"].alias("user_text"))


@query(f"""select doc_id as id, lang as band, text as user_text from documents where {_KIND} > 9""")
def lines_chat(spark, d):
    rows = readers.read_chat_jsonl(spark, line_files(spark, d))
    return rows.select("id", "band", F.get("messages", F.lit(1))["content"].alias("user_text"))


@query(f"""select row_number() over (order by doc_id) - 1 as row_id, case when {_BAD} then concat('Invalid JSONL at line ', doc_id + 1)
    when {_KIND} = 5 then 'row is not a JSON object' when {_KIND} in (6, 7) then 'messages is missing or not a list' end as load_issue
    from documents where {_KIND} <> 3""")
def lines_error_rows(spark, d):
    return readers.read_jsonl_with_error_rows(spark, line_files(spark, d)).select("row_id", "load_issue")


@query("select doc_id, text, lang, case when doc_id % 3 > 0 then source end as source, doc_id % 5 as part from documents")
def jsonl_pooled(spark, d):
    """Flat records written by the JSON Lines writer in several folders and pooled."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", F.expr("case when doc_id % 3 > 0 then source end").alias("source"), F.expr("doc_id % 5").alias("part"))
    base = new_folder(spark, "pool")
    for k in range(2):
        writers.write_jsonl(docs.filter(F.col("doc_id") % 2 == k), f"{base}/{k}")
    return readers.read_flat_jsonl(spark, [f"{base}/0", f"{base}/1"], "doc_id long, text string, lang string, source string, part long")


@query("select doc_id as id, text as user_text from documents")
def json_objects(spark, d):
    """Records as .json files that each hold one list, packed as they are written."""
    docs = table(spark, d, "documents").select("doc_id", "text", F.floor(F.col("doc_id") / 50).alias("g"))
    turns = lambda row: F.array(*[F.struct(F.lit(r).alias("role"), row["text"].alias("content")) for r in validate.ROLES])
    record = lambda row: F.struct(turns(row).alias("messages"), row["doc_id"].cast("string").alias("topic"))
    lists = docs.groupBy("g").agg(F.collect_list(F.struct("doc_id", "text")).alias("rows")).select(F.to_json(F.transform("rows", record)).alias("value"))
    folder = new_folder(spark, "lists")
    lists.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(folder + "/lists.json")
    found = readers.read_json(spark, folder + "/lists.json")
    return found.select(F.col("topic").cast("long").alias("id"), F.get("messages", F.lit(1))["content"].alias("user_text"))


@query("""select doc_id, concat('a "quoted", ', text, chr(10), 'next') as s, case when doc_id % 4 > 0 then lang end as lang from documents""")
def csv_round_trip(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", F.concat(F.lit('a "quoted", '), "text", F.lit("\nnext")).alias("s"), F.expr("case when doc_id % 4 > 0 then lang end").alias("lang"))
    folder = new_folder(spark, "csv")
    writers.write_csv(docs, folder)
    return spark.read.schema(docs.schema).option("header", True).option("escape", '"').option("multiLine", True).csv(folder)


@query(f"""select doc_id, regexp_replace(s, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g') as s, source from (select doc_id, {MARKED} as s, source from documents)""")
def export_clean(spark, d):
    return writers.without_control(documents(spark, d, s=MARKED).select("doc_id", "s", "source"))


@query("""select doc_id, text from documents where doc_id not in (select doc_id from labels)""")
def resume_pending(spark, d):
    return writers.pending(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "labels"), "doc_id")


@query("""select conv_id, string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' order by turn) as rendered
  from conversations group by conv_id""")
def chat_render(spark, d):
    records = readers.assemble_chats(table(spark, d, "conversations"), "conv_id", "turn", "role", "text")
    return records.select(F.col("id").alias("conv_id"), t.render_chat("messages").alias("rendered"))


# ---- file contracts -------------------------------------------------------------

_GEN = "case when doc_id % 23 = 0 then ' ' else text end"


@query(f"""select count(*) as lines, count(distinct id) as unique_ids, count(*) filter ({strip('g')} = '') as empty_generations
  from (select doc_id // 2 as id, {_GEN} as g from documents)""")
def generation_check(spark, d):
    rows = documents(spark, d, g=_GEN).select(F.expr("doc_id div 2").alias("id"), F.col("g").alias("generation"))
    return validate.generation_check(rows)


@query("select id, count(*) as count from (select doc_id % 700 as id from documents) group by id having count(*) > 1")
def repeated_ids(spark, d):
    return validate.repeated_ids(table(spark, d, "documents").select((F.col("doc_id") % 700).alias("id")), "id")


@query(f"""select count(*) filter (q is null) as missing_keys, count(*) filter ({strip('g')} = '') as empty_generations,
  count(id) - count(distinct id) as duplicate_ids
  from (select doc_id % 900 as id, {_GEN} as g, case when doc_id % 31 <> 0 then lang end as q from documents)""")
def contract_violations(spark, d):
    rows = documents(spark, d, g=_GEN).select(
        (F.col("doc_id") % 900).alias("id"), F.col("g").alias("generation"),
        F.when(F.col("doc_id") % 31 != 0, F.col("lang")).alias("question"))
    return validate.contract_violations(rows, ["id", "generation", "question"])


# ---- incremental and whole runs ---------------------------------------------------

@query(VALIDATED + " select id, reason, hash from validated")
def stream_validate(spark, d):
    """The documents as a file stream: checked and deduplicated as they arrive."""
    schema = spark.read.parquet(f"{d}/documents.parquet").schema
    # a pattern, as the table may be one file or a folder of files
    stream = spark.readStream.schema(schema).parquet(f"{d}/documents.parque[t]")
    out = new_folder(spark, "stream")
    incremental.run(incremental.checked_stream(as_chats(stream)), out, f"{out}/checkpoint").awaitTermination()
    return incremental.results(spark, out)


def three_messages(spark, d):
    return chats(spark, d).filter(F.size("messages") >= 3)


_VIEWS = f"""(select doc_id, 'system' as view, {SYSTEM} as text from documents where doc_id % 40 <> 10 union all
  select doc_id, 'user', {USER} from documents where doc_id % 40 <> 10 union all select doc_id, 'assistant', {ASSISTANT} from documents where doc_id % 40 <> 10)"""


_VIEW_STATS = f"({_view_sql(('view',), 'bn', '*').replace('from documents)', 'from ' + _VIEWS + ')')})"
_SCORE = "100 * (0.35 * (1 - jaccard_mean) + 0.25 * distinct_2 + 0.2 * (1 - (count - unique_normalized) / count) + 0.1)"


@query(f"select round(avg({_SCORE}), 2) as score, max(count) as rows from {_VIEW_STATS}")
def audit_overall(spark, d):
    """The overall figure of an audit: the mean of the views' scores."""
    found = audit.view_scores(audit.views(three_messages(spark, d)))
    return found.agg(F.round(F.avg("score"), 2).alias("score"), F.max("count").alias("rows"))


@query(f"select view, round({_SCORE}, 2) as score, count, vocab, total_tokens, jaccard_pairs from {_VIEW_STATS}")
def audit_views(spark, d):
    texts = audit.views(three_messages(spark, d))
    # The sample order hashes the id alone, as the SQL does.
    found = audit.view_scores(texts)
    return found.select("view", F.round("score", 2).alias("score"), "count", "vocab", "total_tokens", "jaccard_pairs")


@query()
def audit_by_subject(spark, d):
    known = audit.with_meta(three_messages(spark, d))
    texts = audit.views(known, ["subject"]).filter("view = 'assistant'")
    return rounded(audit.strata(texts, "subject"))


@query()
def clean_corpus(spark, d):
    return cleaning.clean_corpus(chats(spark, d)).report


# ---- reports and sorted files ---------------------------------------------------

@query("""select 'by_lang' as section, lang as value, count(*) as count from documents group by lang
  union all select 'by_source', source, count(*) from documents group by source""")
def summary_sections(spark, d):
    """Sections of a report, written and read again."""
    rows, folder = table(spark, d, "documents"), new_folder(spark, "sections")
    writers.write_sections({f"by_{c}": stats.value_counts(rows, c).withColumnRenamed(c, "value") for c in ("lang", "source")}, folder)
    parts = [writers.read_section(spark, folder, name, "value string, count long").select(F.lit(name).alias("section"), "value", "count") for name in ("by_lang", "by_source")]
    return parts[0].unionByName(parts[1])


@query("""select concat('| ', coalesce(lang, '-'), ' | ', count(*), ' | ', round(avg(length(text)))::bigint, ' |') as line from documents group by lang
  union all select '| lang | rows | chars |' union all select '|---|---|---|'""")
def report_lines(spark, d):
    """A rendered table of a report, written as text and read again."""
    rows, folder = table(spark, d, "documents"), new_folder(spark, "report")
    report.write_markdown(report.table_markdown(rows.groupBy("lang").agg(
        F.count("*").alias("rows"), F.round(F.avg(F.length("text"))).cast("long").alias("chars"))), folder, spark)
    return spark.read.text(folder).withColumnRenamed("value", "line")


@query("select doc_id, row_number() over (order by doc_id) - 1 as position from documents where length(text) < 1500")
def sorted_output(spark, d):
    """Rows written in the order of their ids, with the places at which the files, one after another, hold them."""
    rows, folder = table(spark, d, "documents").filter("length(text) < 1500").select("doc_id"), new_folder(spark, "sorted")
    writers.write_sorted_jsonl(rows.repartition(7), folder, "doc_id")
    lines = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\n")).alias("line", "json")).filter("json <> ''")
    sizes = lines.groupBy("file").agg(F.count("*").alias("n")).select("file", F.expr("sum(n) over (order by file) - n").alias("before"))
    return lines.join(sizes, "file").select(F.from_json("json", "doc_id long")["doc_id"].alias("doc_id"), (F.col("before") + F.col("line")).cast("long").alias("position"))
