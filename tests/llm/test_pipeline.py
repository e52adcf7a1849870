"""All stages against their brute-force versions, each on what the one before it kept."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline

from .conftest import sentence
from .test_near_copies import slow
from .test_quality import slow_counts


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    texts = [sentence(rng, rng.randint(60, 160)) for _ in range(150)]
    for k in range(0, 150, 30):
        texts[k] = " ".join(w + "###" for w in texts[k].split())  # symbols throughout
    texts += [texts[1]] * 4 + [texts[2] + " one more", "one " + texts[2], texts[3].upper(), "too short", None, "", "same words here " * 60]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path, texts


def test_run(spark, folder):
    path, texts = folder
    poor = {k for k in range(0, 150, 30)}
    kept = [(i, t) for i, t in enumerate(texts) if i not in poor and (c := slow_counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]]
    last = {t: i for i, t in kept}
    kept = [(i, t) for i, t in kept if last[t] == i]
    stays = {i for i, _, _, k in slow(kept) if k}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, t in kept:
        if i in stays:
            ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
            want |= {(i, k, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))}
    got = contract.queries()["pipeline"](spark, path).collect()
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in by.values():
        ends = np.cumsum([0, *[n for _, n in sorted(items)]]).tolist()
        assert [o for o, _ in sorted(items)] == ends[:-1] and ends[-1] <= 4096
    assert len(by) == -(-sum(w[3] for w in want) // 4096)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder[0])
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_copies", "near_copies", "packing"]


def test_near_copies_from_four_fifths_on(spark):
    """Texts of 65 words with one in the middle changed: 56 of 66 shingles are common (0.848), with two changed 0.73."""
    rng, rows = random.Random(4), []
    for k in range(60):
        words = [f"{w}{rng.randint(0, 999)}" for w in sentence(rng, 65).split()]
        rows.append((3 * k, " ".join(words)))
        words[30] = "changed"
        rows.append((3 * k + 1, " ".join(words)))
        words[10] = "again"
        rows.append((3 * k + 2, " ".join([*words[:10], "again", *words[11:40], "third", *words[41:]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i for i, _, _, k in slow(rows, 80) if k}
    assert {r["doc_id"] for r in corpus_pipeline.near(spark, docs, "").collect()} == want != {i for i, _, _, k in slow(rows) if k}


def test_rows_are_dropped_by_id_and_text(spark):
    """Short and copied rows take no other row along that shares their id or lack of one."""
    rng = random.Random(8)
    one, two, three, four = (sentence(rng, 90) for _ in range(4))
    rows = [(None, one), (None, "too short"), (5, two), (5, "short too"), (7, three), (7, four), (3, three + " end"), (9, four + " end"),
            (None, two + " end"), (11, "a " + one + " z"), (11, "b " + one + " y")]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    passed = corpus_pipeline.quality(spark, docs, "")
    assert sorted(((r[0], r[1]) for r in passed.collect()), key=repr) == sorted(((i, t) for i, t in rows if "short" not in t), key=repr)
    kept = {(r[0], r[1]) for r in corpus_pipeline.near(spark, passed, "").collect()}
    assert {(5, two), (3, three + " end"), (7, four)} == {x for x in kept if x[0] != 11} and len([x for x in kept if x[0] == 11]) == 1
    unnamed = spark.createDataFrame([(None, one), (None, one + " end"), (None, two)], "doc_id long, text string")
    assert corpus_pipeline.near(spark, unnamed, "").count() == 2


def test_stages_keep_columns_of_any_name(spark, odd):
    """Columns named like those the stages use inside come through each stage with their values."""
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, "")
        assert out.columns == odd.columns
        rows = out.collect()
        assert all(r[c] == "clash" for r in rows for c in ("_block", "_bits", "_w0", "_w7", "_llm_own", "own", "maybe"))
