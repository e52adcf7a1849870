"""K-means whose restarts share their passes, reports on it, and a planar projection of vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..session import checkpointed


def _vectors(df: DataFrame, id: str, vector: str) -> DataFrame:
    return df.select(id, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("features"))


# ---- k-means: all runs share every pass over the rows -----------------------------

#: Rounds of seeding, candidates a round draws for each centre wanted, and steps of a run at most.
ROUNDS, DRAWN, STEPS = 4, 2, 20
SETTLED = 1e-4


def _points(batch: pa.RecordBatch, vector: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(vector))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the squared distance to it."""
    gaps = (centres * centres).sum(1) - 2 * (points @ centres.T)
    own = gaps.argmin(1)
    return own, np.maximum(0.0, gaps[np.arange(len(points)), own] + (points * points).sum(1))


def _grouped(rows: DataFrame, vector: str, centres: list[np.ndarray], sums: bool) -> dict[tuple[int, int], tuple]:
    """Of every run and centre the rows nearest to it, their squared distances and, if wanted, their sum: one pass, combined within tasks."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [None] * len(centres)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            points = _points(batch, vector)
            for run, c in enumerate(centres):
                own, far = _nearest(points, c)
                new = [np.bincount(own, minlength=len(c)).astype(np.float64), np.bincount(own, far, len(c))]
                if sums:
                    member = np.zeros((len(c), len(points)))
                    member[own, np.arange(len(points))] = 1
                    new.append(member @ points)
                held[run] = new if held[run] is None else [x + y for x, y in zip(held[run], new)]
        for run, parts in enumerate(held):
            if parts is not None:
                k = len(parts[0])
                values = np.column_stack([parts[0], parts[1], *parts[2:]])
                yield pa.record_batch([pa.array([run] * k, pa.int32()), pa.array(np.arange(k, dtype=np.int32)),
                                       pa.array(list(values), pa.list_(pa.float64()))], names=["run", "cluster", "part"])

    parts = rows.select(vector).mapInArrow(task, "run int, cluster int, part array<double>")
    whole = parts.select("run", "cluster", F.posexplode("part").alias("place", "x")).groupBy("run", "cluster", "place").agg(F.sum("x").alias("x"))
    found: dict = {}
    for r in whole.collect():  # as many numbers as all centres have
        found.setdefault((r["run"], r["cluster"]), {})[r["place"]] = r["x"]
    return {key: (v[0], v[1], np.array([v[i] for i in range(2, len(v))])) for key, v in found.items()}


def _drawn(rows: DataFrame, id: str, vector: str, centres: list[np.ndarray], chances: list[float], seed: int) -> list[np.ndarray]:
    """Rows drawn for each run with a chance in proportion to their squared distances; decided by a hash of the id."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            points, luck = _points(batch, vector), batch.column(1).to_numpy()
            for run, (c, chance) in enumerate(zip(centres, chances)):
                own = (luck.astype(np.uint64) * np.uint64(2 * run + 1) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)
                hit = np.flatnonzero(own / 2.0 ** 53 < chance * _nearest(points, c)[1])
                if len(hit):
                    yield pa.record_batch([pa.array([run] * len(hit), pa.int32()), pa.array(list(points[hit]), pa.list_(pa.float64()))], names=["run", "point"])

    drawn: list[list] = [[] for _ in centres]
    for r in rows.select(vector, F.xxhash64(id, F.lit(seed)).alias("luck")).mapInArrow(task, "run int, point array<double>").collect():
        drawn[r["run"]].append(r["point"])
    return [np.array(sorted(d)) for d in drawn]


def _reduced(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k centres from weighted candidates: distances weigh the draw, then a few steps."""
    centres = points[[rng.choice(len(points), p=weights / weights.sum())]]
    while len(centres) < k:
        far = _nearest(points, centres)[1] * weights
        if far.sum() <= 0:
            break
        centres = np.concatenate([centres, points[[rng.choice(len(points), p=far / far.sum())]]])
    for _ in range(STEPS):
        own = _nearest(points, centres)[0]
        held = np.bincount(own, weights, len(centres))
        sums = np.array([np.bincount(own, weights * x, len(centres)) for x in points.T]).T
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1e-300)[:, None], centres)
    return centres


def kmeans(df: DataFrame, id: str, vector: str, ks: Sequence[int], restarts: int = 10, seed: int = 42) -> dict[int, tuple[float, np.ndarray]]:
    """For each ``k`` the cost (squared distances to the nearest centre) and centres of the best of ``restarts`` runs.

    Every pass over the rows serves all runs of all ``k``: seeding draws a few candidates for each centre in proportion to their distances
    over ``ROUNDS`` rounds, and each step sums the rows of all runs' clusters at once. So there are some tens of passes, however many runs.
    """
    runs = [(k, r) for k in ks for r in range(restarts)]
    first = df.agg(*[F.min_by(vector, F.xxhash64(id, F.lit(seed + r))) for r in range(restarts)]).first()
    centres = [np.array([first[r]], np.float64) for _, r in runs]
    for turn in range(ROUNDS):
        costs = np.zeros(len(runs))
        for (run, _), (_, far, _) in _grouped(df, vector, centres, False).items():
            costs[run] += far
        chances = [DRAWN * k / c if c > 0 else 0.0 for (k, _), c in zip(runs, costs)]
        drawn = _drawn(df, id, vector, centres, chances, seed + 1000 * (turn + 1))
        centres = [np.unique(np.concatenate([c, d.reshape(-1, c.shape[1])]), axis=0) for c, d in zip(centres, drawn)]
    weights = [np.zeros(len(c)) for c in centres]
    for (run, cluster), (n, _, _) in _grouped(df, vector, centres, False).items():
        weights[run][cluster] = n
    centres = [_reduced(c, w, k, np.random.default_rng(seed + r)) for c, w, (k, r) in zip(centres, weights, runs)]
    for _ in range(STEPS):
        moved = 0.0
        for (run, cluster), (n, _, total) in _grouped(df, vector, centres, True).items():
            if n > 0:
                moved = max(moved, float(np.linalg.norm(total / n - centres[run][cluster])))
                centres[run][cluster] = total / n
        if moved <= SETTLED:
            break
    costs = np.zeros(len(runs))
    for (run, _), (_, far, _) in _grouped(df, vector, centres, False).items():
        costs[run] += far
    best = {}
    for (k, _), c, cost in zip(runs, centres, costs):
        if k not in best or cost < best[k][0]:
            best[k] = (float(cost), c)
    return best


def kmeans_clusters(df: DataFrame, id: str, vector: str, models: dict[int, tuple[float, np.ndarray]]) -> DataFrame:
    """``id``, ``k``, ``cluster`` and ``away``, the distance to its centre, of every row and model."""
    @F.arrow_udf("array<struct<k: int, cluster: int, away: double>>")
    def find(vectors: pa.Array) -> pa.Array:
        points = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
        met = [(k, *_nearest(points, c)) for k, (_, c) in models.items()]
        flat = [np.stack(x, 1).ravel() for x in zip(*[(np.full(len(points), k, np.int32), own.astype(np.int32), np.sqrt(far)) for k, own, far in met])]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(points) + 1, dtype=np.int32) * len(met)),
                                        pa.StructArray.from_arrays([pa.array(x) for x in flat], ["k", "cluster", "away"]))

    return df.select(id, F.explode(find(vector)).alias("x")).select(id, "x.*")


def kmeans_report(
    df: DataFrame, id: str, vector: str, ks: Sequence[int] = (10, 15, 20), restarts: int = 10, seed: int = 42,
) -> DataFrame:
    """One row per cluster of the best of ``restarts`` runs for each ``k``.

    ``silhouette`` is Spark's, on squared Euclidean distance. A ``k`` is left out
    when there are fewer than two rows per cluster; one cluster scores 0.
    """
    n, schema = df.count(), "k int, cluster int, size long, silhouette double, intra_mean double, inter_mean double"
    ks = [k for k in ks if n >= 2 * k]
    if not ks:
        return df.sparkSession.createDataFrame([], schema)
    models = kmeans(df, id, vector, ks, restarts, seed)
    assigned = checkpointed(kmeans_clusters(df, id, vector, models))
    facts = []
    for k, (_, centres) in models.items():
        own = _vectors(df, id, vector).join(assigned.filter(F.col("k") == k).select(id, F.col("cluster").cast("double").alias("cluster")), id)
        many = assigned.filter(F.col("k") == k).select("cluster").distinct().count() > 1
        silhouette = ClusteringEvaluator(predictionCol="cluster").evaluate(own) if many else 0.0
        apart = [float(np.linalg.norm(a - b)) for a, b in combinations(centres, 2)]
        facts.append((k, float(silhouette), float(np.mean(apart)) if apart else None))
    known = df.sparkSession.createDataFrame(facts, "k int, silhouette double, inter_mean double")
    sizes = assigned.groupBy("k", "cluster").agg(F.count("*").alias("size"))
    whole = assigned.groupBy("k").agg(F.avg("away").alias("intra_mean"))
    return sizes.join(F.broadcast(whole), "k").join(F.broadcast(known), "k").select("k", "cluster", "size", "silhouette", "intra_mean", "inter_mean")


def plane(df: DataFrame, id: str, vector: str) -> DataFrame:
    """First two principal components of the centred vectors (signs are free)."""
    rows = _vectors(df, id, vector)
    centred = StandardScaler(withMean=True, withStd=False, inputCol="features", outputCol="centred").fit(rows).transform(rows)
    model = PCA(k=2, inputCol="centred", outputCol="components").fit(centred)
    found = model.transform(centred).select(id, vector_to_array("components").alias("c"))
    return found.select(id, F.col("c")[0].alias("x"), F.col("c")[1].alias("y"))
