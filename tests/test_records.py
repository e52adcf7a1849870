import json
import pathlib

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from sievework.operators import dedup, validate
from sievework.plans import cleaning, tuning
from sievework.sources import readers, writers
from sievework.streaming import incremental


def record(user="q", assistant="a", roles=("system", "user", "assistant"), system="s"):
    return [{"role": r, "content": c} for r, c in zip(roles, (system, user, assistant))]


CASES = [
    (0, None, validate.TOO_FEW),
    (1, record()[:2], validate.TOO_FEW),
    (2, record(roles=("user", "system", "assistant")), validate.WRONG_ROLES),
    (3, record(user="  \n"), validate.EMPTY_USER),
    (4, record(assistant=None), validate.EMPTY_ASSISTANT),
    (5, record(user="Same question £"), validate.GARBAGE),
    (6, record(assistant="কम"), validate.MIXED),
    (7, record(user="Same question"), None),          # its rejected twin (5) casts no shadow
    (8, record(user="SAME, question!"), validate.EXACT_COPY),
    (9, record(user="Ｓame question"), validate.EXACT_COPY),
    (10, record(user="other") + [{"role": "user", "content": "x"}], None),
]


def frame(spark, cases):
    return spark.createDataFrame([(i, m) for i, m, _ in cases], "id long, messages array<struct<role:string,content:string>>")


def test_first_failing_rule(spark):
    got = validate.validate_records(frame(spark, CASES))
    assert {r["id"]: r["reason"] for r in got.collect()} == {i: want for i, _, want in CASES}
    rows = {r["id"]: r for r in got.collect()}
    assert rows[4]["meta"] is None and rows[5]["meta"] is not None and rows[5]["hash"] is None and len(rows[7]["hash"]) == 16
    kept, rejected = validate.passed(got), validate.quarantined(got)
    assert validate.partition_check(kept, rejected, got).first()["holds"]
    report = validate.rejection_report(kept, rejected).first()
    assert (report["total"], report["final_clean"], report["stage1_pass_rate"]) == (11, 2, 0.1818)
    assert [(r["rank"], r["reason"], r["count"]) for r in report["top_reasons"]][:2] == [
        (1, validate.TOO_FEW, 2), (2, validate.EXACT_COPY, 2)]


def test_result_does_not_depend_on_partitions(spark):
    df = frame(spark, CASES)
    one, two = (sorted((r["id"], r["reason"] or "") for r in validate.validate_records(df.repartition(n)).collect()) for n in (1, 6))
    assert one == two


def test_parse_rows(spark):
    meta = "[metadata: জেলা: মালদা]"
    cases = [
        (0, record(system=meta, assistant="$x"), None, "", "unbalanced dollar math delimiter"),
        (1, record(system="none", user=" "), None, "metadata missing or could not be extracted; missing user question", ""),
        (2, record(system=meta) + [{"role": "user", "content": " last "}], None, "", ""),
        (3, None, None, "messages is missing or not a list", ""),
        (4, None, "Invalid JSONL at line 5", "Invalid JSONL at line 5", ""),
        (5, [], None, "missing system message; missing user question; missing assistant answer", ""),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "row_id long, messages array<struct<role:string,content:string>>, load_issue string")
    got = {r["row_id"]: r for r in validate.parse_rows(df).collect()}
    for i, _, _, issues, quality in cases:
        assert (got[i]["schema_issues"], got[i]["text_quality_issues"], got[i]["schema_valid"]) == (issues, quality, issues == "")
    assert got[2]["question"] == "last" and got[0]["context"] == "জেলা: মালদা"


LINES = [
    json.dumps({"messages": record(user="ক"), "band": "x"}, ensure_ascii=False), "", "{bad", "[1, 2]", "7", '{"a": 1}',
    '{"messages": null}', '{"messages": "text"}', json.dumps({"messages": record()[:2]}), "  ", json.dumps({"messages": record(user="z")})]


def test_readers(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    rows = readers.read_jsonl_quarantine(spark, str(path))
    got = {r["id"]: r["load_issue"] for r in rows.collect()}
    assert got == {0: None, 2: validate.BAD_JSON, 3: validate.NO_MESSAGES, 4: validate.NO_MESSAGES, 5: validate.NO_MESSAGES,
                   6: validate.TOO_FEW, 7: validate.TOO_FEW, 8: None, 10: None}
    reasons = {r["id"]: r["reason"] for r in validate.validate_records(rows).collect()}
    assert reasons[2] == validate.BAD_JSON and reasons[8] == validate.TOO_FEW and reasons[0] is None
    assert sorted(r["id"] for r in readers.read_chat_jsonl(spark, str(path)).collect()) == [0, 10]
    numbered = {r["row_id"]: r["load_issue"] for r in readers.read_jsonl_with_error_rows(spark, str(path)).collect()}
    assert sorted(numbered) == list(range(9)) and numbered[1] == "Invalid JSONL at line 3" and numbered[2] == "row is not a JSON object"
    assert numbered[6] == "messages is missing or not a list"


def test_line_numbers_over_small_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(2000)]
    (tmp_path / "a.txt").write_text("\n".join(lines[:1500]) + "\n")
    (tmp_path / "b.txt").write_text("\n".join(lines[1500:]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["id"]: r["value"] for r in rows} == dict(enumerate(lines))


def test_json_list_object_and_other(spark, tmp_path):
    (tmp_path / "l.json").write_text(json.dumps([{"messages": record()}, {"messages": record()}], indent=1))
    (tmp_path / "o.json").write_text(json.dumps({"messages": record()}, indent=1))
    assert readers.read_json(spark, str(tmp_path / "l.json")).count() == 2
    assert readers.read_json(spark, str(tmp_path / "o.json")).count() == 1
    with pytest.raises(ValueError):
        readers.read_json(spark, "x.csv")


def generation(**changes):
    row = {k: "v" for k in readers.GENERATION_KEYS} | {"truncated": False} | changes
    return json.dumps({k: v for k, v in row.items() if v is not None})


@pytest.mark.parametrize("bad", [generation(id="1"), generation(id="2", topic=None), generation(id="2", generation=" "), "{x"])
def test_strict_reader_fails(spark, tmp_path, bad):
    (tmp_path / "g.jsonl").write_text(generation(id="1", truncated=True) + "\n")
    assert [r["truncated"] for r in readers.read_generations(spark, str(tmp_path / "g.jsonl")).collect()] == [True]
    (tmp_path / "h.jsonl").write_text(generation(id="1") + "\n" + bad + "\n")
    with pytest.raises(Exception) as failure:
        readers.read_generations(spark, str(tmp_path / "h.jsonl")).collect()
    assert isinstance(failure.value, SparkRuntimeException) or "MALFORMED" in str(failure.value) or "Malformed" in str(failure.value)


def test_writers_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "ক \"q\"\n\x01x"), (2, None)], "id long, s string")
    writers.write_jsonl(df, str(tmp_path / "j"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "j").glob("part-*"))
    assert "ক" in text and '"s":null' in text
    clean = writers.without_control(df)
    writers.write_csv(clean, str(tmp_path / "c"))
    back = spark.read.csv(str(tmp_path / "c"), header=True, multiLine=True, escape='"')
    assert {(r["id"], r["s"]) for r in back.collect()} == {("1", "ক \"q\"\nx"), ("2", None)}
    writers.write_summary({"rows": df, "count": df.groupBy().count()}, str(tmp_path / "s"))
    nested = json.loads(next((tmp_path / "s").glob("part-*")).read_text(encoding="utf-8"))
    assert nested["count"] == [{"count": 2}] and len(nested["rows"]) == 2


def test_caps_and_keep_last(spark):
    df = spark.createDataFrame([(i, "k" if i < 30 else f"k{i}") for i in range(40)], "id long, key string")
    capped = dedup.cap_per_key(df, "key", 4, 1, "id")
    assert {r["count"] for r in capped.groupBy("key").count().collect()} == {1, 4}
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # hot keys are cut before the shuffle
    last = dedup.keep_last(spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "id long, n long, v string"), "id", "n")
    assert {(r["id"], r["v"]) for r in last.collect()} == {(1, "b"), (2, "c")}


def test_stream_finds_copies_across_batches_and_replays(spark, tmp_path):
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    source.mkdir()

    def put(name, rows):
        (source / name).write_text("\n".join(json.dumps({"id": i, "messages": m}) for i, m in rows) + "\n{bad\n")

    def go():
        records = incremental.line_stream(spark, str(source))
        incremental.run(incremental.checked_stream(records), str(out), str(state)).awaitTermination()
        return {r["id"]: r["reason"] for r in incremental.results(spark, str(out)).filter("id is not null").collect()}

    put("a.jsonl", [(1, record(user="one")), (2, record(user="ONE")), (3, record(user=""))])
    assert go() == {1: None, 2: validate.EXACT_COPY, 3: validate.EMPTY_USER}
    put("b.jsonl", [(4, record(user="one!")), (5, record(user="two"))])
    want = {1: None, 2: validate.EXACT_COPY, 3: validate.EMPTY_USER, 4: validate.EXACT_COPY, 5: None}
    assert go() == want
    assert go() == want  # nothing new
    assert incremental.results(spark, str(out)).filter(F.col("reason") == validate.BAD_JSON).count() == 2


def test_rows_of_one_id_and_text_pass_once_and_rules_run_once(spark):
    rows = [(1, record(user="one")), (1, record(user="one")), (1, record(user="two")), (0, record(user="TWO"))]
    df = spark.createDataFrame(rows, "id long, messages array<struct<role:string,content:string>>").repartition(3)
    done = validate.validate_records(df)
    assert sorted((r["id"], r["reason"] or "") for r in done.collect()) == [(0, ""), (1, ""), (1, validate.EXACT_COPY), (1, validate.EXACT_COPY)]
    plan = done._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan and "regexp" not in plan.lower()  # normal forms and rules lie in the written table


def test_stream_asks_its_state_and_replays_the_same_files(spark, tmp_path):
    source, state = tmp_path / "in", tmp_path / "state"
    source.mkdir()

    def go(out):
        query = incremental.run(incremental.checked_stream(incremental.line_stream(spark, str(source))), str(out), str(state))
        query.awaitTermination()
        return query

    def files(out, batch):
        return {(r["id"], r["reason"]) for r in incremental.results(spark, str(out)).collect() if r["id"] // 10 == batch}

    for batch in range(3):
        rows = [(10 * batch + k, record(user=u)) for k, u in enumerate(["same", "same", f"own {batch}", f"twice {batch}", f"twice {batch}"], 1)]
        (source / f"{batch}.jsonl").write_text("\n".join(json.dumps({"id": i, "messages": m}) for i, m in rows))
        query = go(tmp_path / "out")
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 7  # one short row for each hash
    assert files(tmp_path / "out", 2) == {(21, validate.EXACT_COPY), (22, validate.EXACT_COPY), (23, None), (24, None), (25, validate.EXACT_COPY)}
    for name in (state / "commits").iterdir():  # the last batch was not committed: it runs again, and needs nothing that was written
        if name.name in ("2", ".2.crc"):
            name.unlink()
    go(tmp_path / "again")
    assert files(tmp_path / "again", 2) == files(tmp_path / "out", 2) and not files(tmp_path / "again", 1)


def test_clean_corpus(spark, tmp_path):
    system = "পাঠ্যসূচি বিবরণী\n- বিষয়: গণিত\n- শ্রেণি: ৭"
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, record(f"{long} first", long, system=system)), (2, record(f"{long} second", long, system=system)),
            (3, record(f"{long} third", long)), (4, record(f"{long} £", long))]
    df = spark.createDataFrame(rows, "id long, messages array<struct<role:string,content:string>>")
    done = cleaning.clean_corpus(df)
    assert sorted(r["id"] for r in done.clean.collect()) == [1, 3]  # other block, so 3 stays
    copy = done.near_copies.first()
    assert copy["id"] == 2 and copy["reasons"][0].startswith("semantic_dupe sim=0.9") and copy["reasons"][0].endswith("vs id 1")
    assert validate.partition_check(done.clean, done.rejected, df).first()["holds"]
    done.write(str(tmp_path))
    assert len(list(tmp_path.iterdir())) == 5
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])], "id long, vector array<double>")
    assert cleaning.clean_corpus(df, vectors).clean.count() == 3


def test_tuning_set(spark, tmp_path):
    rows = [(i, f"প্রশ্ন: {i} + {i % 7} {'common' if i % 3 == 0 else f'kind{chr(97 + i % 13)}'}?\nউত্তর: {i}", "b", "math", "t") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string, band string, subject string, topic string")
    done = tuning.build_tuning_set(df, identity=[("who?", "me"), ("what?", "this")], system="sys")
    card = done.card.first()
    assert card["template_overlap"] == 0 and card["templates"] == 14 and card["eval_templates"] == 2 and card["identity_rows"] == 6
    assert done.train.count() == card["train_rows"] and done.held_out.count() == card["eval_rows"] <= 6
    assert "template_overlap=0\n" in done.text_card
    first = done.train.filter("subject = 'math'").first()
    assert first["messages"][0]["content"] == "sys" and first["messages"][1]["content"].isascii() is False
    done.write(str(tmp_path))
    again = tuning.build_tuning_set(df.repartition(5), identity=[("who?", "me")], system="sys")
    assert {r["messages"][1]["content"] for r in again.held_out.collect()} == {r["messages"][1]["content"] for r in done.held_out.collect()}
    assert tuning.training_texts(done.train).first()["text"].startswith("<|system|>\nsys")


def test_stream_over_a_table_in_many_files(spark, tmp_path):
    from catalog import records

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    folder = str(tmp_path / "tables")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = {r["id"]: r["reason"] for r in records.stream_validate(spark, folder).collect()}
    want = {r["id"]: r["reason"] for r in records.stream_validate(spark, "/root/testdata/sf0.001").collect()}
    assert got == want and len(got) == docs.count()


def test_json_objects_write_their_lists_once_and_packed(spark, tmp_path, monkeypatch):
    from catalog import records

    folders = []
    monkeypatch.setattr(records, "new_folder", lambda _, purpose: folders.append(f"{tmp_path}/{purpose}") or folders[-1])
    spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("ক \"x\"\n" * 200), F.col("id")).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["id"]: r["user_text"] for r in records.json_objects(spark, str(tmp_path)).collect()}
    assert got == {k: "ক \"x\"\n" * 200 + str(k) for k in range(200)}
    files = [f for folder in folders for f in pathlib.Path(folder).rglob("part-*")]
    assert len(folders) == 1 and len(files) == 4 and sum(f.stat().st_size for f in files) < 100_000
