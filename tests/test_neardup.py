"""The keep-first rule against the rule written as a loop."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.operators import cells, neardup


def walk(rows, similar, threshold):
    """(kept, vs) per id, the sequential way; rows: (id, block, value)."""
    kept, verdict = {}, {}
    for id, block, value in sorted(rows, key=lambda r: r[0]):
        for other, there in kept.setdefault(block, []):
            if similar(value, there) > threshold:
                verdict[id] = (False, other)
                break
        else:
            kept[block].append((id, value))
            verdict[id] = (True, None)
    return verdict


def verdicts(df):
    return {r["id"]: (r["kept"], r["vs"]) for r in df.collect()}


def clustered(n, seed, spread):
    """Unit vectors around few centres, one centre holding a third of the rows,
    some of them equal."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    which = np.where(rng.random(n) < 0.33, 0, rng.integers(0, 6, n))
    v = centres[which] + spread * rng.normal(size=(n, 8))
    v[rng.integers(0, n, n // 10)] = v[0]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(int(i), f"b{int(b)}", v[k].tolist()) for k, (i, b) in enumerate(zip(rng.permutation(n), rng.integers(0, 2, n)))]


@pytest.mark.parametrize("spread, block_rows, listed", [
    (0.3, 2048, 8),
    (0.5, 16, 8),      # many blocks, rounds over the lists
    (0.5, 16, 1),      # every list cut: rows are listed again
    (0.9, 32, 2),
])
def test_vectors(spark, spread, block_rows, listed):
    rows = clustered(160, 7, spread)
    df = spark.createDataFrame(rows, "id long, block string, v array<double>")
    got = verdicts(neardup.dedup_by_vector(df, "id", "v", ["block"], 0.88, block_rows, listed))
    want = walk(rows, lambda a, b: float(np.dot(a, b)), 0.88)
    assert got == want
    assert 0 < sum(not k for k, _ in want.values()) < len(rows)


def jaccard(a, b):
    x, y = set(a.split()), set(b.split())
    return len(x & y) / max(1, len(x | y))


@pytest.mark.parametrize("block_rows, listed", [(512, 8), (8, 2), (20, 1)])
def test_token_sets(spark, block_rows, listed):
    rng = np.random.default_rng(3)
    bases = [" ".join(f"w{t}" for t in rng.choice(60, 14, replace=False)) for _ in range(8)]
    rows = []
    for i in range(120):
        words = bases[0 if rng.random() < 0.4 else int(rng.integers(0, 8))].split()
        for _ in range(int(rng.integers(0, 4))):
            words[int(rng.integers(0, len(words)))] = f"w{int(rng.integers(0, 60))}"
        rows.append((i, f"b{i % 2}", " ".join(words)))
    rows += [(200, "b0", ""), (201, "b0", "!"), (202, None, rows[0][2])]
    df = spark.createDataFrame(rows, "id long, block string, text string")
    got = verdicts(neardup.dedup_by_tokens(df, "id", "text", ["block"], 0.6, "word", block_rows, listed))
    cleaned = [(i, b or "?", t.replace("!", "")) for i, b, t in rows]
    assert got == walk(cleaned, jaccard, 0.6)


def test_chain_keeps_both_ends_and_threshold_is_strict(spark):
    def at(angle):
        return [float(np.cos(angle)), float(np.sin(angle))]

    rows = [(0, "x", at(0.0)), (1, "x", at(0.4)), (2, "x", at(0.8)), (3, "y", at(0.0)), (4, "z", [1.0, 0.0]), (5, "z", [0.6, 0.8])]
    df = spark.createDataFrame(rows, "id long, block string, v array<double>")
    got = verdicts(neardup.dedup_by_vector(df, "id", "v", ["block"], 0.88))
    assert got == {0: (True, None), 1: (False, 0), 2: (True, None), 3: (True, None), 4: (True, None), 5: (True, None)}
    strict = verdicts(neardup.dedup_by_vector(df.filter("block = 'z'"), "id", "v", ["block"], 0.6))
    assert strict == {4: (True, None), 5: (True, None)}


def test_prefix_length_loses_no_pair(spark):
    sizes = spark.range(1, 200).select("id", neardup.prefix_length(F.col("id"), 0.88).alias("p")).collect()
    for r in sizes:
        n, least = r["id"], int(np.ceil(round(r["id"] * 0.88, 9)))
        assert r["p"] == n - least + 1 and 1 <= r["p"] <= n


def test_reason_text(spark):
    row = spark.range(1).select(neardup.reason(F.lit(7).cast("long"), F.lit(0.91234)).alias("r")).first()
    assert row["r"] == "semantic_dupe sim=0.912 vs id 7"


@pytest.mark.parametrize("edges", [1_000_000, 200])
def test_a_chain_and_many_ranges(spark, monkeypatch, edges):
    """A chain of 1,000 rows, each close to the one before it alone, settles in one walk or over many ranges."""
    monkeypatch.setattr(neardup, "RANGE_EDGES", edges)
    rounds = []
    monkeypatch.setattr(neardup, "checkpointed", lambda df, real=neardup.checkpointed: (rounds.append(1), real(df))[1])
    lists = spark.createDataFrame([(i, i - 1, 0.9, False) for i in range(1, 1000)] + [(2000, 1999, 0.9, True), (2001, 2000, 0.9, False)], neardup.LIST_SCHEMA)
    state, open_rows = neardup._settle(lists)
    got = {r["id"]: r["kept"] for r in state.collect()}
    assert got == {**{i: i % 2 == 0 for i in range(1000)}, 1999: True, 2000: False, 2001: True}
    assert open_rows.count() == 0 and len(rounds) <= -(-1001 // edges) + 1
    cut = spark.createDataFrame([(5, 3, 0.9, True), (3, 1, 0.9, False), (7, 5, 0.9, False)], neardup.LIST_SCHEMA)
    state, open_rows = neardup._settle(cut)
    assert {r["id"]: r["kept"] for r in state.collect()} == {1: True, 3: False} and {r["id"] for r in open_rows.collect()} == {5, 7}


def test_regions_skip_what_is_far(spark):
    """Clusters on the sphere: the same verdicts, and most cells never taken."""
    from sievework.operators.regions import regions

    rng = np.random.default_rng(1)
    heads = rng.normal(size=(24, 16))
    v = heads[rng.integers(0, 24, 1500)] + 0.15 * rng.normal(size=(1500, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[7] = 0.0
    rows = [(i, "a" if i % 5 else "b", x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "id long, block string, v array<double>")
    got = verdicts(neardup.dedup_by_vector(df, "id", "v", ["block"], 0.88, 64, 4, 48, 16))
    assert got == walk(rows, lambda a, b: float(np.dot(a, b)), 0.88)
    work = regions(df.withColumnRenamed("v", "vector"), ["block"], "id", "vector", 64, 48, 16).work(0.88).first()
    assert work["taken"] + work["skipped"] == work["cells"] and work["skipped"] > 0.5 * work["cells"]


def test_cells_stay_whole_behind_a_join(spark):
    """A join on the cell that turns into a broadcast at run time leaves no cell in two tasks."""
    def sizes(table, bounds):
        yield pa.RecordBatch.from_arrays([pa.array(np.diff(bounds).astype(np.int64))], names=["n"])

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 2000, 1, 7).select("id", (F.col("id") % 50).cast("string").cast("binary").alias("_cell"))
        asked = rows.filter("id < 40").select("_cell").distinct()
        found = [r.n for r in cells.run_cells(rows.join(asked, "_cell", "left_semi"), sizes, "n long").collect()]
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert sorted(found) == [40] * 40


def test_zero_vectors_are_no_copies(spark):
    """Equal rows of no length are not similar beyond a threshold, so both stay."""
    df = spark.createDataFrame([(1, "a", [0.0, 0.0]), (2, "a", [0.0, 0.0]), (3, "a", [1.0, 0.0]), (4, "a", [1.0, 0.0])], "id long, block string, v array<double>")
    assert verdicts(neardup.dedup_by_vector(df, "id", "v", ["block"], 0.88)) == {1: (True, None), 2: (True, None), 3: (True, None), 4: (False, 3)}


def test_blocks_are_written_once(spark):
    """A bucket of many blocks and one of a single block: every pair is met once, every row of the large one is written once."""
    def count(table):
        low, high, same = cells.sides(table)
        yield pa.RecordBatch.from_arrays([table["g"][:1].combine_chunks(), pa.array([len(low) * (len(low) - 1) // 2 if same else len(low) * len(high)])], names=["g", "n"])

    rows = spark.range(230).select("id", F.when(F.col("id") < 200, F.lit("large")).alias("g"))
    groups = rows.groupBy("g").agg(cells.block_count(F.count("*"), 30).alias("k"))
    placed = rows.withColumn("k", F.when(F.col("g").isNotNull(), 7).otherwise(1))
    buckets = cells.Buckets(placed, groups, ["g"], "k", "id")
    found = buckets.run(cells.each_cell(count), "g string, n long")
    assert {r["g"]: r["n"] for r in found.groupBy("g").agg(F.sum("n").alias("n")).collect()} == {"large": 199 * 100, None: 29 * 15}
    assert spark.read.parquet(buckets.large.folder).count() == 200


def test_a_set_goes_to_two_places_whatever_its_size(spark, monkeypatch):
    """Crowded bands of large sets: what is written for the pairs grows with the sets, not with their rare tokens."""
    rng = np.random.default_rng(8)
    rows = [(i, "a", " ".join(f"w{t}" for t in rng.choice(20_000, 120 + i % 7, replace=False))) for i in range(150)]
    rows += [(200 + i, "a", rows[i][2] + " w1000") for i in range(0, 150, 5)]
    df = spark.createDataFrame(rows, "id long, block string, text string")
    placed = []

    class Counted(cells.Buckets):
        def __init__(self, rows, *more):
            placed.append(rows.count())
            super().__init__(rows, *more)

    monkeypatch.setattr(neardup, "Buckets", Counted)
    got = verdicts(neardup.dedup_by_tokens(df, "id", "text", ["block"], 0.6, "word", 8))
    assert got == walk([(i, b, t) for i, b, t in rows], jaccard, 0.6)
    assert placed and max(placed) <= 2 * len(rows)


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.6, 0.88, 1.0])
@pytest.mark.parametrize("few", [0.0, 1e9])
def test_similar_pairs_of_a_cell_with_and_without_rare_tokens(monkeypatch, threshold, few):
    monkeypatch.setattr(cells, "FEW_MEET", few)
    rng = np.random.default_rng(4)
    sets = [set(np.minimum(rng.zipf(1.3, int(n)), 900).tolist()) for n in rng.integers(1, 60, 240)]
    for i in range(0, 200, 5):
        sets[i + 1] = sets[i] ^ {1000 + i}
    table = pa.table({"set": pa.array([sorted(x) for x in sets], pa.list_(pa.int64())), "n": [len(x) for x in sets], "rest": [len(x) - 1 for x in sets]})
    token_sets = cells.TokenSets(table, "set", "n", "rest", threshold)
    found = {}
    for a, b, sim in token_sets.near(np.arange(0, 150), np.arange(90, 240)):
        for i, j, s in zip(a.tolist(), b.tolist(), sim.tolist()):
            assert (i, j) not in found
            if i != j:  # a row of both sides
                found[i, j] = s
    of = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(150) for j in range(90, 240) if i != j}
    assert found == pytest.approx({k: s for k, s in of.items() if s > threshold})


def test_sets_without_a_common_rare_token_are_not_compared(monkeypatch):
    """Sets of common tokens with a few of their own: at a high threshold no pair but the near copies is looked at."""
    rng = np.random.default_rng(6)
    sets = [[*range(40), *(100 + rng.choice(5_000_000, 20, replace=False))] for _ in range(600)]
    sets[300] = [*sets[7][:-1], 90]
    table = pa.table({"set": pa.array(sets, pa.list_(pa.int64())), "n": [60] * 600, "rest": [59] * 600})
    token_sets = cells.TokenSets(table, "set", "n", "rest", 0.88)
    monkeypatch.setattr(token_sets, "possible", lambda a, b: pytest.fail("all pairs are looked at"))
    (a, b, sim), = [x for x in token_sets.near(np.arange(300), np.arange(300, 600)) if len(x[0])]
    assert (a.tolist(), b.tolist()) == ([7], [300]) and sim[0] == pytest.approx(59 / 61)
