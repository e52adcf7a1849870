"""Documents with every odd case that the operators define a result for."""

import random

import pytest

#: Names that the operators use inside.
CLASHING = ["row", "digest", "group", "label", "part", "n", "key", "length", "set", "size", "bits", "block", "node", "distance", "x0", "offset", "piece", "_llm_id", "_block", "_bits", "_w0", "_w7", "_key", "_row", "_llm_own", "_llm_row", "own", "maybe"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
WORDS = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were her all she there would their".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed"]) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    rng = random.Random(5)
    base = [sentence(rng, 80) for _ in range(12)]
    out = [None, "", " ", "\n\t ", "One", "one", "ONE two", "a b c d", "A  b\tc d", "é à  ü\nß", "日本語 テスト 😀", "x" * 70_000, *base]
    out += [base[0], base[0], base[0].upper(), base[1] + " tail", base[1].replace(" ", "  ", 3), base[2] + "\n" + base[2], "### *** $$$ %%% " * 40]
    out += [sentence(rng, 30_000), "Licensed under CC BY-NC 4.0.", "under the MIT license under the mit LICENSE", "\r\n".join(base[3:6]), "it's DON'T 12 3.5 <|endoftext|> a\x0bb"]
    return out


@pytest.fixture(scope="session")
def odd(spark, texts):
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "s3"][i % 4], None if t is None else len(t), *["clash"] * len(CLASHING)) for i, t in enumerate(texts)]
    rows.append(rows[13])  # a repeated row
    rows.append((None, texts[12], "en", "s1", 1, *["clash"] * len(CLASHING)))
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
