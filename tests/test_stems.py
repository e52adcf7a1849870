"""Examples from the published description of the algorithm."""

import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from sievework.functions import scores, stems
from sievework.functions.stems import porter_stems, stem


@pytest.mark.parametrize("word, want", [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "ti"), ("caress", "caress"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"),
    ("plastered", "plaster"), ("bled", "bled"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"),
    ("sized", "size"), ("hopping", "hop"), ("tanned", "tan"), ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"), ("failing", "fail"),
    ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("conditional", "condit"), ("rational", "ration"),
    ("digitizer", "digit"), ("operator", "oper"), ("feudalism", "feudal"), ("decisiveness", "decis"), ("hopefulness", "hope"), ("formaliti", "formal"),
    ("triplicate", "triplic"), ("formative", "form"), ("formalize", "formal"), ("electrical", "electr"), ("hopeful", "hope"), ("goodness", "good"),
    ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"), ("airliner", "airlin"), ("adjustable", "adjust"), ("defensible", "defens"),
    ("irritant", "irrit"), ("replacement", "replac"), ("adjustment", "adjust"), ("dependent", "depend"), ("adoption", "adopt"), ("communism", "commun"),
    ("activate", "activ"), ("homologous", "homolog"), ("effective", "effect"), ("bowdlerize", "bowdler"), ("probate", "probat"), ("rate", "rate"),
    ("cease", "ceas"), ("controll", "control"), ("roll", "roll")])
def test_stem(word, want):
    assert stem(word) == want


def test_stemmed_rouge(spark):
    df = spark.createDataFrame([("the dogs were running", "the dog was running"), ("hopping cats", "hopped cat")], "r string, h string")
    got = [r["x"]["rouge1"] for r in df.select(scores.rouge("r", "h", stemmer=porter_stems).alias("x")).collect()]
    assert got == [pytest.approx(0.75), pytest.approx(1.0)]


def test_each_token_of_a_batch_is_stemmed_once(spark, monkeypatch):
    rows = [(0, ["running", None, "the"]), (1, None), (2, []), (3, ["running", "hopping"])]
    df = spark.createDataFrame(rows, "i int, w array<string>").coalesce(1)
    assert [r["s"] for r in df.orderBy("i").select(porter_stems(F.col("w")).alias("s")).collect()] == [["run", None, "the"], None, [], ["run", "hop"]]
    seen = []
    monkeypatch.setattr(stems, "stem", lambda w: seen.append(w) or stem(w))
    assert stems._stems.func(pa.array([["running", "cats"] * 3, ["running"]])).to_pylist() == [["run", "cat"] * 3, ["run"]]
    assert sorted(seen) == ["cats", "running"]
