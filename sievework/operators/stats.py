"""Corpus statistics. Every function takes grouping columns ``by``; with none
given, the whole frame is one group and one row comes back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import hash_normalize, preview, tokens
from .grouping import named, with_keys
from .ngrams import ngram_counts
from .ordering import hash_key

COUNTS = ["total_tokens", "vocab", "jaccard_pairs"]
RATIOS = ["ttr", "distinct_1", "distinct_2", "distinct_3",
          "jaccard_mean", "jaccard_p95", "jaccard_max", "jaccard_share_gt_08"]


def _side_by_side(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Join small per-group frames; a null group is a group of its own."""
    def pair(left: DataFrame, right: DataFrame) -> DataFrame:
        renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                               *[c for c in right.columns if c not in keys])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
        return left.join(renamed, same, "left").drop(*[f"_r_{k}" for k in keys])

    return reduce(pair, parts)


def _complete(df: DataFrame, found: DataFrame, keys: list[str], by: Sequence[str]) -> DataFrame:
    """``found`` for every group of ``df``, zeros for a group it lacks."""
    return named(_zeros(_side_by_side([df.select(*keys).distinct(), found], keys)), by)


def _zeros(df: DataFrame) -> DataFrame:
    return df.na.fill(0, [c for c in COUNTS if c in df.columns]).na.fill(0.0, [c for c in RATIOS if c in df.columns])


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


# ---- lengths and duplicates -------------------------------------------------

def _summary(value: str, rows: str) -> list[Column]:
    """Mean, median, population deviation, extremes and 95th percentile of a
    value that occurs ``rows`` times."""
    v, n = F.col(value).cast("double"), F.col(rows)
    mean = F.sum(v * n) / F.sum(n)
    spread = F.sum(v * v * n) / F.sum(n) - mean * mean
    quantiles = F.percentile(v, F.array(F.lit(0.5), F.lit(0.95)), n)
    return [
        mean.alias(f"{value}_mean"),
        quantiles[0].alias(f"{value}_median"),
        F.sqrt(F.greatest(spread, F.lit(0.0))).alias(f"{value}_std"),
        F.min(value).alias(f"{value}_min"),
        F.max(value).alias(f"{value}_max"),
        quantiles[1].alias(f"{value}_p95"),
    ]


def _text_features(df: DataFrame, text: str, keys: list[str], kind: str) -> DataFrame:
    """Counts of (digest of the normal form, characters, words), which both the
    length and the duplicate statistics read."""
    form = "word" if kind == "word" else "bn"
    return (
        df.select(
            *keys,
            F.unhex(F.sha2(hash_normalize(text, form), 256)).alias("digest"),
            F.length(text).alias("chars"),
            F.size(tokens(text, kind)).alias("words"),
        )
        .groupBy(*keys, "digest", "chars", "words")
        .agg(F.count("*").alias("rows"))
    )


def length_stats(df: DataFrame, text: str, by: Sequence[str] = (), kind: str = "bn") -> DataFrame:
    """Character and word length statistics; quantiles interpolate linearly."""
    df, keys = with_keys(df, by)
    features = _text_features(df, text, keys, kind)
    return named(features.groupBy(*keys).agg(*_summary("chars", "rows"), *_summary("words", "rows")), by)


def duplicate_stats(df: DataFrame, text: str, by: Sequence[str] = (), kind: str = "bn") -> DataFrame:
    """Rows, distinct normal forms, surplus copies, their rate and group count."""
    df, keys = with_keys(df, by)
    return named(_duplicates(_text_features(df, text, keys, kind), keys), by)


def _duplicates(features: DataFrame, keys: list[str]) -> DataFrame:
    forms = features.groupBy(*keys, "digest").agg(F.sum("rows").alias("rows"))
    total, unique = F.sum("rows"), F.count("*")
    return forms.groupBy(*keys).agg(
        total.alias("count"),
        unique.alias("unique_normalized"),
        (total - unique).alias("exact_duplicates"),
        _ratio(total - unique, total).alias("duplicate_rate"),
        F.count_if(F.col("rows") > 1).alias("duplicate_groups"),
    )


# ---- n-grams ----------------------------------------------------------------

def ngram_stats(df: DataFrame, text: str, by: Sequence[str] = (), kind: str = "bn") -> DataFrame:
    """Tokens, vocabulary, type-token ratio and distinct-1/2/3.

    What is sent between tasks is the different places of a batch in a few bytes
    each (``ngrams``); no group is ever collected.
    """
    df, keys = with_keys(df, by)
    return _complete(df, _ngrams(df, text, keys, kind), keys, by)


def _ngrams(df: DataFrame, text: str, keys: list[str], kind: str) -> DataFrame:
    counted = ngram_counts(df, text, tokens(text, kind), keys)
    return counted.select(
        *keys,
        F.col("total_1").alias("total_tokens"),
        F.col("distinct_1").alias("vocab"),
        _ratio(F.col("distinct_1"), F.col("total_1")).alias("ttr"),
        *[_ratio(F.col(f"distinct_{n}"), F.col(f"total_{n}")).alias(f"distinct_{n}") for n in (1, 2, 3)],
    )


# ---- sampled Jaccard --------------------------------------------------------

def jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two arrays of distinct tokens, 0 when either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def jaccard_sample(
    df: DataFrame, text: str, id: str, by: Sequence[str] = (), kind: str = "bn",
    sample: int = 300, stride: int = 10, seed: int = 0,
) -> DataFrame:
    """Jaccard of each tenth sampled text with its next nine.

    The sample is the feature: the first ``sample`` texts of each group in hash
    order. ``share_gt_08`` is the true share of pairs above 0.8.
    """
    df, keys = with_keys(df, by)
    return _complete(df, _jaccards(df, text, id, keys, kind, sample, stride, seed), keys, by)


def _jaccards(
    df: DataFrame, text: str, id: str, keys: list[str], kind: str, sample: int, stride: int = 10, seed: int = 0,
) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(hash_key(seed, id), id))
    picked = (
        df.select(*keys, id, text).withColumn("_rank", rank).filter(F.col("_rank") <= sample)
        .select(
            *keys,
            F.floor((F.col("_rank") - 1) / stride).alias("_window"),
            ((F.col("_rank") - 1) % stride).alias("_place"),
            F.array_distinct(tokens(text, kind)).alias("_set"),
        )
    )
    anchors = picked.filter("_place = 0").select(
        *[F.col(k).alias(f"_a_{k}") for k in keys],
        F.col("_window").alias("_a_window"), F.col("_set").alias("_a_set"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_a_{k}")) for k in keys])
    scored = (
        picked.filter("_place > 0").join(anchors, same & (F.col("_window") == F.col("_a_window")))
        .select(*keys, jaccard(F.col("_a_set"), F.col("_set")).alias("j"))
    )
    return scored.groupBy(*keys).agg(
        F.avg("j").alias("jaccard_mean"),
        F.percentile("j", F.lit(0.95)).alias("jaccard_p95"),
        F.max("j").alias("jaccard_max"),
        F.avg((F.col("j") > 0.8).cast("double")).alias("jaccard_share_gt_08"),
        F.count("*").alias("jaccard_pairs"),
    )


# ---- whole views ------------------------------------------------------------

def view_stats(
    df: DataFrame, text: str, id: str, by: Sequence[str] = (), kind: str = "bn", sample: int = 300,
) -> DataFrame:
    """All light statistics of a text view, one row per group."""
    df, keys = with_keys(df, by)
    features = _text_features(df, text, keys, kind)
    lengths = features.groupBy(*keys).agg(*_summary("chars", "rows"), *_summary("words", "rows"))
    parts = [
        _duplicates(features, keys),
        lengths,
        _ngrams(df, text, keys, kind),
        _jaccards(df, text, id, keys, kind, sample),
    ]
    return named(_zeros(_side_by_side(parts, keys)), by)


def diversity_score(
    mean_similarity: Column | None = None, entropy_norm: Column | None = None,
) -> Column:
    """0 to 100 from similarity, distinct-2, duplicate rate and an entropy.

    Without a similarity the sampled Jaccard mean stands in; without an entropy
    its neutral value 0.5 does.
    """
    similarity = F.col("jaccard_mean")
    if mean_similarity is not None:
        similarity = F.coalesce(mean_similarity, similarity)
    entropy = F.lit(0.5) if entropy_norm is None else F.coalesce(entropy_norm, F.lit(0.5))
    spread = 1 - F.greatest(F.lit(0.0), F.least(F.lit(1.0), similarity))
    return (0.35 * spread + 0.25 * F.col("distinct_2") + 0.2 * (1 - F.col("duplicate_rate")) + 0.2 * entropy) * 100


# ---- frequencies ------------------------------------------------------------

def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("count"))


def top_values(df: DataFrame, value: Column, id: str, k: int, name: str = "value") -> DataFrame:
    """The ``k`` most frequent values, ties by first appearance."""
    counts = df.groupBy(value.alias(name)).agg(F.count("*").alias("count"), F.min(id).alias("first_id"))
    return counts.orderBy(F.desc("count"), "first_id").limit(k)


def top_starts(df: DataFrame, text: str, id: str, k: int = 5) -> DataFrame:
    """Most frequent beginnings of 80 characters."""
    return top_values(df, preview(text, 80), id, k, "start")


def duplicate_examples(df: DataFrame, text: str, id: str, k: int = 5, kind: str = "bn") -> DataFrame:
    """The most frequent normal forms that occur more than once."""
    form = hash_normalize(text, "word" if kind == "word" else "bn")
    rows = df.select(id, form.alias("_form")).select(
        id, F.sha2("_form", 256).alias("_digest"), F.substring("_form", 1, 150).alias("normalized"))
    groups = rows.groupBy("_digest").agg(
        F.min_by("normalized", id).alias("normalized"), F.count("*").alias("count"), F.min(id).alias("first_id"))
    return groups.drop("_digest").orderBy(F.desc("count"), "first_id").limit(k).filter("count > 1")


def entropy(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Shannon entropy in bits, its maximum and the ratio; zeros for one class."""
    df, keys = with_keys(df, by)
    counts = df.groupBy(*keys, F.col(value).alias("_value")).agg(F.count("*").alias("c"))
    total, classes = F.sum("c"), F.count("*")
    bits = F.log2(total) - F.sum(F.col("c") * F.log2("c")) / total
    many = classes > 1
    return named(counts.groupBy(*keys).agg(
        classes.alias("classes"),
        F.when(many, bits).otherwise(0.0).alias("entropy"),
        F.when(many, F.log2(classes)).otherwise(0.0).alias("max_entropy"),
        F.when(many, bits / F.log2(classes)).otherwise(0.0).alias("entropy_norm"),
    ), by)


def head_coverage(df: DataFrame, value: str, by: Sequence[str] = (), top: int = 5, share: float = 0.1) -> DataFrame:
    """Share of rows in the most frequent values, singletons and repeats.

    Values are ranked through the histogram of their counts, whose length grows
    only with the square root of the rows.
    """
    df, keys = with_keys(df, by)
    counts = df.groupBy(*keys, F.col(value).alias("_value")).agg(F.count("*").alias("c"))
    histogram = counts.groupBy(*keys, "c").agg(F.count("*").alias("m"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = histogram.select(
        *keys, "c", "m",
        F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("_ahead"),
        F.sum("m").over(group).alias("_values"),
    )

    def covered(limit: Column) -> Column:
        taken = F.greatest(F.lit(0), F.least(F.col("m"), limit - F.col("_ahead")))
        return F.sum(taken * F.col("c")) / F.sum(F.col("c") * F.col("m"))

    tenth = F.greatest(F.lit(1), F.floor(F.col("_values") * F.lit(share)))
    return named(ranked.groupBy(*keys).agg(
        F.sum("m").alias("values"),
        F.coalesce(F.sum(F.when(F.col("c") == 1, F.col("m"))), F.lit(0)).alias("singletons"),
        F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("m"))), F.lit(0)).alias("repeated"),
        covered(F.lit(top)).alias("top_cover"),
        covered(tenth).alias("head_cover"),
    ), by)


def count_matrix(df: DataFrame, row: str, column: str, columns: Sequence[str], total: str = "total", other: str | None = None) -> DataFrame:
    """Two-key counts as a matrix with row and column totals.

    ``columns`` fixes the column order (see ``class_order``); ``other`` names one more for all other values."""
    if other is not None:
        df = df.withColumn(column, F.when(F.col(column).cast("string").isin(*columns), F.col(column).cast("string")).otherwise(other))
        columns = [*columns, other]
    cells = df.cube(row, column).agg(F.count("*").alias("n"), F.grouping(row).alias("_gr"), F.grouping(column).alias("_gc"))
    named = cells.select(
        F.when(F.col("_gr") == 1, total).otherwise(F.col(row).cast("string")).alias(row),
        F.col("_gr"),
        F.when(F.col("_gc") == 1, total).otherwise(F.col(column).cast("string")).alias("_c"),
        "n",
    )
    wide = named.groupBy("_gr", row).pivot("_c", [*columns, total]).agg(F.first("n"))
    return wide.na.fill(0).orderBy("_gr", row).drop("_gr")


def class_order(values: Sequence[str]) -> list[str]:
    """Numbers by value, then all other names as they come."""
    numbers = sorted((v for v in values if v.isdecimal()), key=int)
    return numbers + [v for v in values if not v.isdecimal()]


def frequent_values(df: DataFrame, column: str, most: int = 1_000) -> tuple[list[str], bool]:
    """The ``most`` frequent values for the columns of a report, and whether there are more."""
    counts = df.groupBy(F.col(column).cast("string").alias("_v")).count().filter("_v is not null")
    found = [r[0] for r in counts.orderBy(F.desc("count"), "_v").limit(most + 1).collect()]
    return class_order(sorted(found[:most])), len(found) > most


# ---- sizes ------------------------------------------------------------------

def size_audit(df: DataFrame, columns: Sequence[str], chars_per_token: int = 4) -> DataFrame:
    """Characters per row over several columns: integer mean, p50 and p95 by
    index into the sorted sizes, maximum and estimated tokens.

    The sizes are reduced to a histogram first; ranks are taken on that."""
    size = reduce(Column.__add__, [F.length(F.coalesce(F.col(c), F.lit(""))) for c in columns])
    histogram = df.select(size.cast("long").alias("v")).groupBy("v").agg(F.count("*").alias("m"))
    order = Window.orderBy("v")
    ranked = histogram.select(
        "v", "m",
        F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_n"),
    )

    def at(index: Column) -> Column:
        return F.min(F.when(F.col("_upto") > index, F.col("v")))

    total, rows = F.sum(F.col("v") * F.col("m")), F.sum("m")
    return ranked.agg(
        rows.alias("rows"),
        F.floor(total / rows).alias("mean_chars"),
        at(F.floor(F.col("_n") / 2)).alias("p50_chars"),
        at(F.floor(F.col("_n") * F.lit(0.95))).alias("p95_chars"),
        F.max("v").alias("max_chars"),
        F.floor(total / chars_per_token).alias("est_tokens"),
    )


def missing_answers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with at least one null or empty answer."""
    missing = reduce(Column.__or__, [F.coalesce(F.col(c), F.lit("")) == "" for c in columns])
    return df.agg(F.count("*").alias("rows"), F.count_if(missing).alias("missing"))


#: Accuracy of the sketch that narrows a quantile's range, and values that are ordered at once.
ACCURACY, ORDERED = 10_000, 20_000


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[tuple[str, float], float | None]:
    """Exact quantiles of numeric columns, linear between neighbours; nulls do not count, a column without values gives null.

    Each rank's range of values is narrowed by a sketch around it and checked by counting, until its rows are
    equal or so few that they are put in order. No buffer holds more than the sketch or ``ORDERED`` values; a pass
    narrows all ranks of all columns at once, some thousandfold each.
    """
    number = {c: F.col(c).cast("double") for c in columns}
    facts = df.agg(*[F.struct(F.count(x), F.min(x), F.max(x)) for x in number.values()]).first()
    size = {c: f[0] for c, f in zip(columns, facts)}
    found: dict[tuple[str, int], float] = {}
    # rank -> least and greatest value of its range, rows below it, rows inside
    open_ = {(c, r): (f[1], f[2], 0, f[0]) for c, f in zip(columns, facts) if f[0]
             for q in shares for r in {floor((f[0] - 1) * q), ceil((f[0] - 1) * q)}}
    while open_:
        few = {k: v for k, v in open_.items() if v[0] == v[1] or v[3] <= ORDERED}
        ordered = {k: v for k, v in few.items() if v[0] != v[1]}
        found |= {k: v[0] for k, v in few.items() if v[0] == v[1]}
        if ordered:
            row = df.agg(*[F.sort_array(F.collect_list(F.when(number[c].between(lo, hi), number[c])))[r - below] for (c, r), (lo, hi, below, _) in ordered.items()]).first()
            found |= dict(zip(ordered, row))
        wide = {k: v for k, v in open_.items() if k not in few}
        if not wide:
            break
        near = []
        for (c, r), (lo, hi, below, inside) in wide.items():
            at = (r - below) / max(1, inside - 1)
            near.append(F.percentile_approx(F.when(number[c].between(lo, hi), number[c]), [max(0.0, at - 2 / ACCURACY), min(1.0, at + 2 / ACCURACY)], ACCURACY))
        bounds = df.agg(*near).first()
        counts = df.agg(*[F.struct(F.count_if(number[c] < a), F.count_if(number[c].between(a, b))) for (c, _), (a, b) in zip(wide, bounds)]).first()
        open_ = {}
        for ((c, r), (lo, hi, below, inside)), (a, b), (less, within) in zip(wide.items(), bounds, counts):
            if less <= r < less + within and (a, b) != (lo, hi):
                open_[c, r] = (a, b, less, within)
            else:  # the sketch missed the rank or cannot narrow its range: halve the values
                middle = lo + (hi - lo) / 2
                middle = lo if middle >= hi else middle
                less = df.agg(F.count_if(number[c] <= middle)).first()[0]
                upper = df.agg(F.min(F.when(number[c] > middle, number[c]))).first()[0]
                open_[c, r] = (lo, middle, below, less - below) if r < less else (upper, hi, less, below + inside - less)
    out = {}
    for c in columns:
        for q in shares:
            at = (size[c] - 1) * q
            low, high = floor(at), ceil(at)
            out[c, q] = None if not size[c] else found[c, low] + (found[c, high] - found[c, low]) * (at - low)
    return out


def describe_scores(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, one row per column."""
    names = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    at = exact_quantiles(df, columns, list(names.values()))
    metrics = F.array(*[F.struct(
        F.lit(c).alias("metric"), F.col(c).cast("double").alias("v"),
        *[F.lit(at[c, q]).cast("double").alias(name) for name, q in names.items()]) for c in columns])
    return df.select(F.explode(metrics).alias("p")).select("p.*").groupBy("metric", *names).agg(
        F.count("v").alias("count"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    ).select("metric", "count", "mean", "std", "min", *names, "max")
