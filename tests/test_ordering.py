import hashlib

from pyspark.sql import functions as F

from sievework.operators.ordering import mark_first, shuffled, with_position


def md5(seed, key):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


def test_mark_first_takes_exactly_the_first_in_hash_order(spark):
    df = spark.range(0, 500)
    order = sorted(range(500), key=lambda i: (md5(3, i), i))
    for n in (0, 1, 7, 250, 499, 500, 900):
        got = mark_first(df, 3, "id", lambda total: F.lit(n), "first").filter("first").select("id").collect()
        assert {r["id"] for r in got} == set(order[:n])


def test_mark_first_reads_facts_and_leaves_no_trace(spark):
    df = spark.range(0, 300)
    got = mark_first(df, 1, "id", lambda total: F.floor(total / 3), "first", spark.range(1).select(F.lit(5).alias("other")))
    assert got.filter("first").count() == 100 and set(got.columns) == {"id", "first"}


def test_positions_follow_the_id_on_any_partitioning(spark):
    ids = [i * i * 7 for i in range(400)]
    df = spark.createDataFrame([(i,) for i in reversed(ids)], "id long")
    for parts in (1, 7):  # ids are far from evenly spaced
        got = {r["id"]: r["position"] for r in with_position(df.repartition(parts), "id").collect()}
        assert got == {v: k for k, v in enumerate(ids)}


def test_shuffle_is_seeded_and_independent_of_partitions(spark):
    df = spark.range(0, 50)
    one = [r["id"] for r in shuffled(df.repartition(3), 9, "id").collect()]
    two = [r["id"] for r in shuffled(df.repartition(8), 9, "id").collect()]
    assert one == two == sorted(range(50), key=lambda i: (md5(9, i), i))
    assert one != [r["id"] for r in shuffled(df, 10, "id").collect()]
