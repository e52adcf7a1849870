"""Quality rules with robust multivariate outliers.

Each text gives counts and a vector of transformed statistics. Location and scatter of the
vectors are minimum-covariance-determinant estimates for each language and source: starting
from medians and deviations, concentration steps keep the rows nearest to the estimate and
estimate again from these, which never raises the determinant; a reweighted step ends it.
A row far from its estimate by Mahalanobis distance is rejected.

A concentration step is one grouped aggregate: sums and products of the vectors by group and
bin of the distance. The kept part is the least number of whole bins with at least ``part`` of
the rows. Tasks combine their rows before the shuffle, so a group of any size is a few hundred
rows there; only the estimates, one row per group, are joined to the rows.

Every source has its own estimate, whatever its size, and so have every language and the whole table. A source's
estimate is drawn towards that of its language, this one towards that of the table, and the last one towards
a wide prior: an estimate of ``n`` rows weighs ``n^2 / (n^2 + own^2)``. So a source of a few rows is judged nearly as its
language is, a large one by itself, and a table of a few rows rejects nearly nothing, without a size at which that switches.

Shares of lines and words are taken over a few more lines and words than a text has (``MORE_LINES``, ``MORE_WORDS``), as one
repeated line of three says less than twenty of sixty.

Defined results: a null text has no words and fails the base rules; a null language or source
is a value of its own. Repeated rows and ties are judged alike; an empty table gives an empty result. A very long text
is measured whole in one task, which holds its words and numbers for them. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .bloom import without
from .common import join_groups, landed, sliced, tidy

SYMBOLS = b"#*$%&|<>"
#: The statistics of a vector and the least deviation each is given, so that one that is the same nearly everywhere stays usable;
#: small enough that each of them alone can reject a text far below what the base rules allow.
FEATURES = {"word_length": 0.05, "symbols": 0.04, "dup_lines": 0.03, "repeats": 0.035, "variety": 0.03}
MORE_LINES, MORE_WORDS = 10, 50
#: Deviations of the prior, in least deviations.
PRIOR = 5.0
D = len(FEATURES)
X = [f"x{i}" for i in range(D)]
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
BINS_PER_OCTAVE = 16


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words in three-word windows that occur twice or more, and the number of different words."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(words) < 4:
        return 0, len(number)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1 << 20:  # keep the next product within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, at, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again, covered = times[at] > 1, np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= again
    return int(covered.sum()), len(number)


def measure(text: str) -> tuple:
    """The counts of a text and its vector."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return (0, 0, len(data) - len(data.translate(None, SYMBOLS)), 0, 0, *[0.0] * D)
    chars = len(b"".join(words).decode())
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if not x.isspace() and x]
    dup = len(lines) - len(set(lines))
    repeats, distinct = repeated_words(words)
    return (n, chars, symbols, dup, repeats, log(chars / n), (symbols / chars) ** 0.5, dup / (len(lines) + MORE_LINES),
            repeats / (n + MORE_WORDS), log(distinct) / log(n) if n > 1 else 1.0)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        columns = list(zip(*[measure(t or "") for t in batch.column(3).to_pylist()]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), *[pa.array(c, pa.int64()) for c in columns[:5]],
             *[pa.array(c, pa.float64()) for c in columns[5:]]],
            names=["doc_id", "lang", "source", *COUNTS, *X])


def statistics(df: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per row of ``df``: ids, counts, ``base_failed`` and the vector ``x0`` to ``x4``."""
    rows = df.select(df[id].alias("doc_id"), df[lang].cast("string").alias("lang"), df[source].cast("string").alias("source"), df[text].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{x} double" for x in X)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.mapInArrow(tidy(_measured), schema).withColumn("base_failed", failed)


def gamma_part(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    term = total = 1 / a
    for k in range(1, 10_000):
        term *= x / (a + k)
        total += term
        if term < total * 1e-16:
            break
    return min(1.0, total * exp(-x + a * log(x) - lgamma(a)))


def chi2_quantile(p: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if gamma_part(d / 2, mid / 2) < p else (low, mid)
    return high


def consistency(part: float) -> float:
    """What the scatter of the nearest ``part`` of normal rows is multiplied by."""
    return part / gamma_part(D / 2 + 1, chi2_quantile(part, D) / 2) if part < 1 else 1.0


def _inverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Location, scatter and precision of each group from its count, sums and products."""
    floor = np.diag(np.square(list(FEATURES.values())))
    pairs = [(i, j) for i in range(D) for j in range(i, D)]
    for batch in batches:
        out = {"group": [], "all": [], "center": [], "scatter": [], "precision": [], "log_det": []}
        for row in batch.to_pylist():
            n, factor = row["n"], consistency(min(1.0, row["n"] / row["all"])) if row["concentrated"] else 1.0
            center, scatter = np.array(row["sums"]) / n, np.zeros((D, D))
            for (i, j), v in zip(pairs, row["products"]):
                scatter[i, j] = scatter[j, i] = v / n
            scatter = factor * (scatter - np.outer(center, center)) + floor
            out["group"].append(row["group"])
            out["all"].append(row["all"])
            out["center"].append(center.tolist())
            out["scatter"].append(scatter.ravel().tolist())
            out["precision"].append(np.linalg.inv(scatter).ravel().tolist())
            out["log_det"].append(float(np.linalg.slogdet(scatter)[1]))
        many = pa.list_(pa.float64())
        yield pa.record_batch([pa.array(out["group"], pa.string()), pa.array(out["all"], pa.int64()), pa.array(out["center"], many),
                               pa.array(out["scatter"], many), pa.array(out["precision"], many), pa.array(out["log_det"], pa.float64())], names=list(out))


def blended(levels: list[tuple[int, np.ndarray, np.ndarray]], own: float) -> tuple[np.ndarray, np.ndarray]:
    """Location and scatter of a mixture: each level (rows, location, scatter), the widest first, weighs by its rows against those before it."""
    center, scatter = levels[0][1], np.diag(np.square(PRIOR * np.array(list(FEATURES.values()))))
    for n, c, s in levels:
        w = n * n / (n * n + own * own)
        gap = c - center
        center, scatter = center + w * gap, w * s + (1 - w) * scatter + w * (1 - w) * np.outer(gap, gap)
    return center, scatter


def _squared_distance() -> Column:
    gap = [F.col(x) - F.col("center")[i] for i, x in enumerate(X)]
    terms = [(1 if i == j else 2) * F.col("precision")[i * D + j] * gap[i] * gap[j] for i in range(D) for j in range(i, D)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(total, F.lit(0.0))


def _name(level: int, *keys: str) -> Column:
    return F.to_json(F.struct(F.lit(level).alias("level"), *keys), {"ignoreNullFields": "false"})


def _levels() -> list[Column]:
    """The groups of a row: the whole table, its language, its language and source."""
    return [_name(0), _name(1, "lang"), _name(2, "lang", "source")]


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(X)],
            *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"p{i}_{j}") for i in range(D) for j in range(i, D)]]


def _again() -> list[Column]:
    names = ["n", *[f"s{i}" for i in range(D)], *[f"p{i}_{j}" for i in range(D) for j in range(i, D)]]
    return [F.sum(c).alias(c) for c in names]


def _estimates(sums: DataFrame, concentrated: bool) -> DataFrame:
    packed = sums.select("group", "n", "all", F.array(*[f"s{i}" for i in range(D)]).alias("sums"),
                         F.array(*[f"p{i}_{j}" for i in range(D) for j in range(i, D)]).alias("products"), F.lit(concentrated).alias("concentrated"))
    return landed(packed.mapInArrow(_inverse, "group string, all long, center array<double>, scatter array<double>, precision array<double>, log_det double"), "estimates")


def robust_estimates(rows: DataFrame, part: float = 0.75, steps: int = 10, settled: float = 1e-3, own: float = 25.0) -> DataFrame:
    """``lang``, ``source``, ``center``, ``precision`` of the rows that pass the base rules."""
    grouped = rows.select(*X, F.explode(F.array(*_levels())).alias("group"))
    total = rows.count() * 3
    middle = landed(grouped.groupBy("group").agg(F.count(F.lit(1)).alias("all"), *[
        F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q{i}") for i, x in enumerate(X)]), "medians")
    spread = [F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(f)) for i, f in enumerate(FEATURES.values())]
    precision = [F.lit(0.0) if i != j else 1 / F.pow(spread[i], 2) for i in range(D) for j in range(D)]
    counts = middle.select("group", "all")
    estimates = middle.select("group", "all", F.array(*[F.col(f"q{i}")[1] for i in range(D)]).alias("center"), F.array(*precision).alias("precision"))

    def measured(estimates: DataFrame) -> DataFrame:
        return join_groups(grouped, estimates.select("group", "all", "center", "precision"), "group", "all", total).withColumn("far", _squared_distance())

    before = None
    for _ in range(steps):
        bin = F.floor(F.log2(F.col("far") + 1e-9) * BINS_PER_OCTAVE)
        by_bin = measured(estimates).groupBy("group", "all", bin.alias("bin")).agg(*_sums())
        below = by_bin.withColumn("before", F.expr("sum(n) over (partition by group order by bin) - n")).filter(F.col("before") < part * F.col("all"))
        estimates = _estimates(below.groupBy("group", "all").agg(*_again()), True)
        if before is not None:
            old = before.select("group", F.col("log_det").alias("old"))
            if estimates.join(old, "group").filter(F.abs(F.col("log_det") - F.col("old")) > settled).isEmpty():
                break
        before = estimates
    near = measured(estimates).filter(F.col("far") <= chi2_quantile(0.975, D))
    final = _estimates(near.groupBy("group").agg(*_sums()).join(counts, "group"), False)

    def level(k: int) -> DataFrame:
        return final.select(F.col("group").alias(f"g{k}"), F.struct("all", "center", "scatter").alias(f"l{k}"))

    def blend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centers, precisions = [], []
            for levels in zip(*[batch.column(f"l{k}").to_pylist() for k in range(3)]):
                center, scatter = blended([(x["all"], np.array(x["center"]), np.array(x["scatter"]).reshape(D, D)) for x in levels], own)
                centers.append(center.tolist())
                precisions.append(np.linalg.inv(scatter).ravel().tolist())
            many = pa.list_(pa.float64())
            yield pa.record_batch([batch.column("lang"), batch.column("source"), pa.array(centers, many), pa.array(precisions, many)],
                                  names=["lang", "source", "center", "precision"])

    sources = rows.select("lang", "source").distinct().select("lang", "source", *[g.alias(f"g{k}") for k, g in enumerate(_levels())])
    table = F.broadcast(level(0).filter(F.col("g0") == _name(0)))  # one row
    known = sources.join(table, "g0").join(level(1), "g1").join(level(2), "g2")
    return landed(known.select("lang", "source", "l0", "l1", "l2").mapInArrow(
        blend, "lang string, source string, center array<double>, precision array<double>"), "blended")


def quality_rules(
    df: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    tail: float = 1e-5, part: float = 0.75, own: float = 25.0,
) -> DataFrame:
    """Counts, ``base_failed``, ``distance`` (squared, null without an estimate) and ``kept`` of each row.

    ``tail`` is the share of normally distributed rows that the method would reject; a group of ``own`` rows weighs as much as what it is drawn to.
    """
    rows = landed(statistics(df, id, text, lang, source), "statistics")
    passed = rows.filter("not base_failed")
    estimates = robust_estimates(passed, part, own=own)
    known = estimates.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    judged = rows.join(known, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    distance = F.when(F.col("center").isNotNull(), _squared_distance())
    kept = ~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= chi2_quantile(1 - tail, D))
    return judged.select("doc_id", *COUNTS, "base_failed", distance.alias("distance"), kept.alias("kept"), *X)


def drop_poor(df: DataFrame, id: str = "doc_id", text: str = "text", **columns) -> DataFrame:
    """The rows of ``df`` that are kept, whole, each judged by its own text, language and source whatever ids it shares."""
    names = {"lang": "lang", "source": "source"} | {c: columns.pop(c) for c in ("lang", "source") if c in columns}
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    own = F.struct(F.col(id).alias("id"), digest.alias("digest"), *[F.col(c).cast("string").alias(k) for k, c in names.items()])
    rows = df.select(own.alias("own"), F.col(text).alias("text"), *[F.col(c).alias(k) for k, c in names.items()])
    judged = landed(quality_rules(rows, "own", **columns).select("doc_id", "kept"), "judged")
    return without(df, own, judged.filter("not kept").select("doc_id"))
