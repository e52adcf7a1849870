import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.functions import meta, text as t

YA1, YA2 = "য়", "য়"


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "s string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("function, given, want", [
    (lambda: t.normalize_digits("s"), "০১২৩৪৫৬৭৮৯ 5", "0123456789 5"),
    (lambda: t.numerals("s", "bengali"), "3.5 ক", "৩.৫ ক"),
    (lambda: t.numerals("s", "keep"), "3 ৩", "3 ৩"),
    (lambda: t.strip("s"), "   a b\x1f\n", "a b"),
    (lambda: t.tokens("s", "bn"), "Éa১২ কলম-X9 ও", ["a12", "কলম", "x9", "ও"]),
    (lambda: t.tokens("s", "word"), "জল Été_1", ["জল", "été_1"]),
    (lambda: t.tokens("s", "space"), "A\x1fb　 c", ["A", "b", "c"]),
    (lambda: t.hash_normalize("s", "word"), " A, b!\t\nC_1 ", "a b c_1"),
    (lambda: t.hash_normalize("s", "bn"), "কি, ১২!", "কি 12"),
    (lambda: t.hash_normalize("s", "nfkc"), "ＡＢ ﬁ", "ab fi"),
    (lambda: t.template("s"), " ৩.৫ + 12 = ?\nx 4", "#.# + # = ?"),
    (lambda: t.split_question("s"), " প্রশ্ন ： কত?\nউত্তর: ৫", "কত?"),
    (lambda: t.split_answer("s"), "প্রশ্ন: ক\nউত্তর:\n ৫\nউত্তর: ৬ ", "৫\nউত্তর: ৬"),
    (lambda: t.split_answer("s"), " no label ", "no label"),
    (lambda: t.split_answer("s"), "উত্তর:", ""),
    (lambda: t.strip_layout("s"), "a\n```x £\n ___ = -\nb", "a\n \nb"),
    (lambda: t.has_garbage("s"), "```£\nfine", False),
    (lambda: t.has_garbage("s"), "cost 5€", True),
    (lambda: t.has_mixed_script("s"), "কम", True),
    (lambda: t.has_mixed_script("s"), "मক", True),
    (lambda: t.has_mixed_script("s"), "ক म", False),
    (lambda: t.has_mixed_script("s"), "ক।म", True),
    (lambda: t.text_issues("s"), "$\tx $ $\x01", "illegal control character; corrupted math expression after dollar sign; unbalanced dollar math delimiter"),
    (lambda: t.text_issues("s"), "$a$", ""),
    (lambda: t.text_issues("s"), None, "answer is not a string"),
    (lambda: t.last_number("s"), "1,234 then -২.৫ kg", -2.5),
    (lambda: t.last_number("s"), "none", None),
    (lambda: t.final_answer("s"), "x\nচূ" + "ড়" + "ান্ত উত্তর： ৫ টি\nmore", "৫ টি"),
    (lambda: t.final_answer("s"), " first \nsecond", "first "),
    (lambda: t.answer_key("s"), "৪. টি 7", "4."),
    (lambda: t.answer_key("s"), " ABC ", "abc"),
    (lambda: t.choice_letter("s"), "éA or B)", "B"),
    (lambda: t.choice_letter("s"), "A dog", "A"),
    (lambda: t.truncate("s", 3), " abcd ", "abc …[truncated]"),
    (lambda: t.preview("s", 4), "a\nbcd", "a | bc"),
    (lambda: t.token_estimate("s", 3.5), "", 1),
    (lambda: t.token_estimate("s", 3.5), "x" * 15, 4),
    (lambda: t.is_degenerate("s"), "so so so SO what", True),
    (lambda: t.is_degenerate("s"), "so so so what", False),
    (lambda: t.is_degenerate("s"), " \n", True),
    (lambda: t.context_block("s"), "a\nCONTEXT\nb\nCONTEXT\nc", "b\nCONTEXT\nc"),
    (lambda: t.context_block("s"), "CONTEXT a CONTEXT b", " b"),
])
def test_text(spark, function, given, want):
    assert one(spark, function(), given) == want


def test_content_hash_is_the_digest_of_the_normal_form(spark):
    import hashlib

    assert one(spark, t.content_hash("s"), "Ｈello, ৫!") == hashlib.sha256("hello 5".encode()).hexdigest()[:16]


def test_nfkc_agrees_with_the_unicode_data_and_leaves_ascii(spark):
    values = ["plain", "é é ﬁ ½ Å", "ক" + YA1, None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert [r["x"] for r in df.select(t.nfkc("s").alias("x")).collect()] == [
        None if v is None else unicodedata.normalize("NFKC", v) for v in values]


PIPE = "Intro\n[metadata: জেলা: মালদা | শ্রেণী: ১০ম | বিষ{ya}: রসা{ya}ন (Chem) | পাঠ্য অধ্যা{ya}: ]"
BULLETS = "পাঠ্যসূচি বিবরণী\n- বিষ{ya}: জীবন বিজ্ঞান\n- শ্রেণি: দশম\n- বিষ{ya}বস্তু: \n- অঞ্চল/জেলা: মালদা"


@pytest.mark.parametrize("ya", [YA1, YA2])
def test_metadata_in_both_spellings(spark, ya):
    m = one(spark, meta.parse_meta("s"), PIPE.format(ya=ya))
    assert (m["district"], m["class"], m["chapter"]) == ("মালদা", "১০ম", "]")  # an empty last field
    assert one(spark, meta.subject_norm(meta.parse_meta("s")["subject"]), PIPE.format(ya=ya)) == "Chem"
    m = one(spark, meta.parse_meta("s"), BULLETS.format(ya=ya))
    # The empty field runs on into the next bullet line.
    assert (m["district"], m["class"], m["chapter"]) == ("মালদা", "দশম", "অঞ্চল/জেলা: মালদা")
    c = one(spark, meta.parse_curriculum("s"), "x" * 2000 + BULLETS.format(ya=ya))
    assert (c["subject"], c["class"]) == ("জীবন বিজ্ঞান", "দশম")
    lines = one(spark, meta.judge_context("s"), PIPE.format(ya=ya)).split("\n")
    assert [line.split(": ", 1)[1] for line in lines] == ["মালদা", "১০ম", f"রসা{ya}ন (Chem)"]


@pytest.mark.parametrize("given, want", [
    ("রসা" + YA1 + "ন", "Chemistry"), ("রসা" + YA2 + "ন", "Chemistry"), ("জীবন বিজ্ঞান", "Science"), (" Art ", "Art"), ("x ( y )", "y")])
def test_subject_norm(spark, given, want):
    assert one(spark, meta.subject_norm("s"), given) == want


@pytest.mark.parametrize("given, want", [
    ("১০ম", "10"), (" দশম ", "10"), ("২" + YA1, "2"), ("class 7", "7"), ("শ্রেণি ১২", "12"), ("একাদশ", "11"), ("none", "none")])
def test_class_norm(spark, given, want):
    assert one(spark, meta.class_norm("s"), given) == want


def test_english_context(spark):
    s = "topic: two\nlines  \nstate: WB\ngrade: 7 | x\ndistrict:  |"
    row = spark.createDataFrame([(s,)], "s string").select(
        meta.context_topic("s").alias("topic"), meta.context_field("s", "Grade").alias("grade"),
        meta.context_field("s", "district").alias("district"), meta.context_field("s", "setting").alias("setting")).first()
    assert tuple(row) == ("two\nlines", "7", "", "UNKNOWN")


def test_chat_rendering(spark):
    df = spark.sql("select array(struct('user' as role, 'q' as content), struct('assistant' as role, cast(null as string) as content)) as m")
    assert df.select(t.render_chat("m").alias("x")).first()["x"] == "<|user|>\nq<|end|>\n<|assistant|>\n<|end|>\n"
    assert df.select(t.render_chat("m", "[{role}] {content};").alias("x")).first()["x"] == "[user] q;[assistant] ;"
    with pytest.raises(ValueError):
        t.numerals(F.col("m"), "roman")


def test_nfkc_takes_a_few_texts_at_a_time(monkeypatch):
    most = []
    monkeypatch.setattr(t, "NFKC_ROWS", 3)
    monkeypatch.setattr(t.unicodedata, "normalize", lambda form, x, normalize=t.unicodedata.normalize: most.append(x) or normalize(form, x))
    assert t._nfkc.func(pa.array(["ﬁ", None, "①", "é"])).to_pylist() == ["fi", None, "1", "é"]
    assert most == ["ﬁ", "①", "é"] and t._nfkc.func(pa.array([], pa.string())).to_pylist() == []
