"""Near-duplicate removal with the keep-first rule.

Within a bucket a row is dropped when it is more similar than the threshold to
an earlier row that was itself kept. Three steps give exactly the result of the
sequential rule:

1. Rows equal in what is compared collapse to their first id. A later one is
   always dropped: what drops the first drops it too, else the first does.
2. Cells of bounded size list, for each row, its few smallest earlier
   neighbours, and mark a list that was cut.
3. Walks over ranges of these lists settle rows: a kept earlier neighbour drops a row;
   none kept, none open and no list cut keeps it. A row whose listed neighbours
   all fell while its list was cut is listed again among the rows still standing.

So a bucket of very many copies never puts its pairs anywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import tokens
from ..session import checkpointed
from .cells import BLOCK_ROWS, Buckets, TokenSets, block_count, dense, each_cell, sides
from .grouping import join_groups
from .regions import CENTRES, ROWS_A_CENTRE, regions

LISTED = 8
#: Tokens of one block of sets, and its rows at thresholds at which few pairs share a rare token (``TokenSets.near``).
BLOCK_TOKENS, SET_ROWS, FEW_ABOVE = 2_000_000, 8192, 0.7
#: Edges of one range of ids, walked by one task.
RANGE_EDGES = 1_000_000
LIST_SCHEMA = "id long, other long, sim double, cut boolean"


def _neighbour_lists(similar: Callable, listed: int) -> Callable:
    """Cell work: up to ``listed`` smallest earlier ids above the threshold; ``similar`` of a cell gives the similar pairs of two lists of its rows."""
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        low, high, same = sides(table)
        if len(low) == 0 or len(high) == 0:
            return
        ids = table["id"].to_numpy()
        asks, stands = table["asks"].to_numpy(), table["stands"].to_numpy()
        near = similar(table)
        later, earlier, values = [], [], []
        # guests of a bucket have met each other in their own one
        own = table["own"].to_numpy() if "own" in table.column_names else np.ones(table.num_rows, bool)
        for side, against in ((low[own[low]], high), (low[~own[low]], high[own[high]])):
            for a, b, s in near(side, against) if len(side) and len(against) else ():
                if same:
                    once = ids[a] > ids[b]
                    a, b, s = a[once], b[once], s[once]
                swap = ids[a] < ids[b]
                a, b = np.where(swap, b, a), np.where(swap, a, b)
                use = asks[a] & stands[b]
                later.append(ids[a[use]])
                earlier.append(ids[b[use]])
                values.append(s[use])
        if not later:
            return
        j, i, s = map(np.concatenate, (later, earlier, values))
        if not len(j):
            return
        order = np.lexsort((i, j))
        j, i, s = j[order], i[order], s[order]
        _, first, counts = np.unique(j, return_index=True, return_counts=True)
        place = np.arange(len(j)) - np.repeat(first, counts)
        cut = (place == listed - 1) & (np.repeat(counts, counts) > listed)
        use = place < listed
        yield pa.RecordBatch.from_arrays(
            [pa.array(j[use]), pa.array(i[use]), pa.array(s[use]), pa.array(cut[use])], names=["id", "other", "sim", "cut"])

    return work


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One walk over a range of ids in their order: settles every row whose earlier neighbours are all known by then.

    Rows are edges ``id``, ``other``, with the verdict on ``other`` if an earlier round gave one; a row without ``other`` only
    names its id. Out come verdicts (no ``other``; null where a cut list leaves the row open) and the edges still to be met.
    """
    verdicts: dict[int, bool] = {}

    def settle(id: int, edges: list[tuple]) -> list[tuple]:
        cut, left = any(e[1] for e in edges), []
        for other, _, known in edges:
            if known is None:
                known = verdicts.get(other)
            if known:
                verdicts[id] = False
                return [(id, None, cut, False)]
            if known is None:
                left.append(other)
        if left:
            return [(id, other, cut, None) for other in left]
        if not cut:
            verdicts[id] = True
        return [(id, None, cut, None if cut else True)]

    current, edges = None, []
    for batch in batches:
        out = []
        for id, other, cut, known in zip(*(c.to_pylist() for c in batch.columns)):
            if id != current:
                if current is not None:
                    out += settle(current, edges)
                current, edges = id, []
            if other is not None:
                edges.append((other, cut, known))
        yield _settled(out)
    if current is not None:
        yield _settled(settle(current, edges))


def _settled(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["id", "other", "cut", "kept"])


def _settle(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rounds over the neighbour lists: ``id, kept`` of the settled rows, and the ``id`` of rows whose cut lists leave them open.

    Edges are dealt by ranges of ids, and a neighbour's id is always smaller; a round walks through every range at once, so a chain within a
    range settles in one round and there are at most as many rounds as ranges. A round writes one table and
    passes on only the edges whose neighbour lies in an earlier range and was open there.
    """
    edges = lists.select("id", "other", "cut", F.lit(None).cast("boolean").alias("known"))
    named = lists.select(F.col("other").alias("id")).distinct().select("id", F.lit(None).cast("long").alias("other"), F.lit(False).alias("cut"), F.lit(None).cast("boolean").alias("known"))
    waiting = edges.unionByName(named)
    ranges = max(1, -(-lists.count() // RANGE_EDGES))
    every = open_rows = None
    while True:
        walked = checkpointed(waiting.repartitionByRange(ranges, "id").sortWithinPartitions("id", F.col("other").asc_nulls_first()).mapInArrow(
            _walk, "id long, other long, cut boolean, kept boolean"))
        settled = walked.filter("kept is not null").select("id", "kept")
        stuck = walked.filter("other is null and kept is null").select("id")
        every = settled if every is None else every.unionByName(settled)
        open_rows = stuck if open_rows is None else open_rows.unionByName(stuck)
        going = walked.filter("other is not null")
        left = going.count()
        if ranges == 1 or left == 0 or settled.isEmpty():  # in one range, what still waits waits for open rows
            return every, open_rows.unionByName(going.select("id").distinct())
        waiting = going.drop("kept").join(settled.select(F.col("id").alias("other"), F.col("kept").alias("known")), "other", "left").select("id", "other", "cut", "known")
        ranges = max(1, -(-left // RANGE_EDGES))


def _greedy(scan: Callable[[DataFrame | None, DataFrame | None], DataFrame]) -> DataFrame:
    """``id, vs, sim`` of the dropped rows. ``scan(asking, fallen)`` lists earlier
    neighbours of the asking rows among those not fallen."""
    lists = checkpointed(scan(None, None))
    extra = lists
    while True:
        state, open_rows = _settle(lists)
        if open_rows.isEmpty():
            break
        # List the open rows again, now without the rows known to be dropped.
        more = checkpointed(scan(open_rows, state.filter("not kept").select("id")))
        extra = extra.unionByName(more)
        lists = checkpointed(lists.join(open_rows, "id", "left_anti").unionByName(more))
    kept = state.filter("kept").select(F.col("id").alias("other"), F.lit(True).alias("_kept"))
    fallen = state.filter("not kept").select("id")
    found = extra.join(fallen, "id").join(kept, "other", "left")
    standing_other = F.when(F.col("_kept"), F.col("other"))
    best = found.groupBy("id").agg(
        F.min(standing_other).alias("vs"),
        F.min(F.when(F.col("cut"), F.col("other"))).alias("cut_at"),
        F.min_by("sim", standing_other).alias("sim"),
    )
    best = checkpointed(best)
    unsure = best.filter("vs is null or cut_at < vs").select("id")
    if unsure.isEmpty():
        return best.select("id", "vs", "sim")
    again = scan(unsure, fallen).groupBy("id").agg(F.min("other").alias("vs"), F.min_by("sim", "other").alias("sim"))
    return best.join(unsure, "id", "left_anti").select("id", "vs", "sim").unionByName(again)


def _with_copies(dropped: DataFrame, copies: DataFrame, self_sim: Column) -> DataFrame:
    """Verdict of every row: ``id, kept, vs, sim``. A copy of a kept row falls to
    that row, a copy of a dropped one to what dropped it."""
    verdicts = copies.join(dropped.withColumnRenamed("id", "_first"), "_first", "left")
    is_first = F.col("id") == F.col("_first")
    return verdicts.select(
        "id",
        (is_first & F.col("vs").isNull()).alias("kept"),
        F.when(F.col("vs").isNotNull(), F.col("vs")).when(~is_first, F.col("_first")).alias("vs"),
        F.when(F.col("vs").isNotNull(), F.col("sim")).when(~is_first, self_sim).alias("sim"),
    )


def _scanner(rows: DataFrame, run: Callable[[DataFrame, bool], DataFrame]) -> Callable:
    """``run`` lists neighbours among flagged rows, with its second argument only in cells in which a row asks."""
    def scan(asking: DataFrame | None, fallen: DataFrame | None) -> DataFrame:
        if asking is None:
            flagged = rows.withColumn("asks", F.lit(True)).withColumn("stands", F.lit(True))
        else:  # rows that were dropped stay away, and so do cells in which no row asks
            standing = rows.join(fallen, "id", "left_anti").withColumn("stands", F.lit(True))
            asked = rows.join(asking, "id", "left_semi").select("id", F.lit(True).alias("asks"))
            flagged = standing.join(asked, "id", "left").na.fill({"asks": False}).unionByName(
                rows.join(fallen, "id", "left_semi").join(asked, "id").withColumn("stands", F.lit(False)))
        return run(flagged, asking is not None).groupBy("id", "other").agg(
            F.max("sim").alias("sim"), F.bool_or("cut").alias("cut"))

    return scan


def _asked(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the buckets in which a row asks."""
    return placed.join(placed.filter("asks").select(*keys).distinct(), list(keys), "left_semi")


def _buckets(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Bucket columns as strings under names of their own; null counts as ``?``."""
    keys = [f"_key{i}" for i in range(len(by))]
    return df.select("*", *[F.coalesce(F.col(b).cast("string"), F.lit("?")).alias(k) for b, k in zip(by, keys)]), keys


def _form(values: Column) -> Column:
    """What identifies equal arrays. Never null, or the join on it would push a
    null check, and with it all that makes the array, down to the scan."""
    return F.concat_ws("-", F.xxhash64(values), F.xxhash64(F.lit(1), values))


def _first_of_equals(rows: DataFrame, by: Sequence[str], *values: str) -> DataFrame:
    """Adds ``_first``, the least id of the rows equal in bucket and form; a form that many rows have is met where they lie."""
    keys = [*by, "_form"]
    firsts = rows.groupBy(*keys).agg(F.min("id").alias("_first"), F.count("*").alias("_n"))
    return checkpointed(join_groups(rows, firsts, keys, "_n", rows.count()).select("id", "_first", *by, *values))


def dedup_by_vector(
    df: DataFrame, id: str, vector: str, by: Sequence[str], threshold: float = 0.88, block_rows: int = BLOCK_ROWS, listed: int = LISTED,
    centres: int = CENTRES, rows_a_centre: int = ROWS_A_CENTRE,
) -> DataFrame:
    """Keep-first by cosine of unit vectors inside buckets ``by``.

    Large buckets are dealt into regions; those too far apart for the threshold never meet.
    """
    rows, by = _buckets(df, by)
    rows = rows.select(F.col(id).cast("long").alias("id"), *by, F.col(vector).alias("vector"))
    size = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    # a vector that does not reach the threshold with itself is no copy of its equals
    form = F.when(size > threshold, _form(F.col("vector"))).otherwise(F.col("id").cast("string"))
    copies = _first_of_equals(checkpointed(rows.select("id", *by, "vector", F.coalesce(form, F.lit("")).alias("_form"))), by, "vector")
    dealt = regions(copies.filter("id = _first").drop("_first"), by, "id", "vector", block_rows, centres, rows_a_centre)

    def similar(table: pa.Table) -> Callable:
        matrix = dense(table, "vector")

        def near(side: np.ndarray, against: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            strip = max(1, 1_000_000 // len(against))
            for start in range(0, len(side), strip):
                rows = side[start:start + strip]
                sim = matrix[rows] @ matrix[against].T
                r, c = np.nonzero(sim > threshold)
                yield rows[r], against[c], sim[r, c]

        return near

    def run(flagged: DataFrame, some: bool) -> DataFrame:
        return dealt.run(each_cell(_neighbour_lists(similar, listed)), LIST_SCHEMA, threshold, rows=flagged, asked=some)

    dropped = _greedy(_scanner(dealt.rows, run))
    return _with_copies(dropped, copies.withColumn("_size", size), F.col("_size"))


def prefix_length(size: Column, threshold: float) -> Column:
    """Tokens of a set, rarest first, among which a set similar beyond the
    threshold must share one: ``n - ceil(t n) + 1``."""
    return (size - F.ceil(F.round(size * F.lit(threshold), 9)) + 1).cast("int")


def token_set(text: Column | str, kind: str = "bn") -> Column:
    """The different tokens of a text, each by its 64-bit hash."""
    return F.sort_array(F.array_distinct(F.transform(tokens(text, kind), lambda w: F.xxhash64(w))))


def dedup_by_tokens(
    df: DataFrame, id: str, text: str, by: Sequence[str], threshold: float = 0.88, kind: str = "bn", block_rows: int | None = None, listed: int = LISTED,
) -> DataFrame:
    """Keep-first by Jaccard of token sets inside buckets ``by``."""
    return dedup_by_sets(df.select(id, *by, token_set(text, kind).alias("_set")), id, "_set", by, threshold, block_rows, listed)


def dedup_by_sets(
    df: DataFrame, id: str, tokens: str, by: Sequence[str], threshold: float = 0.88, block_rows: int | None = None, listed: int = LISTED,
) -> DataFrame:
    """Keep-first by Jaccard of the sets that ``token_set`` gives, inside buckets ``by``.

    Of two sets similar beyond the threshold the larger has fewer than ``1 / t`` times the tokens of the smaller,
    so it lies in the size band of the smaller or in the next, and a set goes to its own band and the next: to two places, whatever
    its size. Blocks are counted by rows and by tokens; a band of one set, or of sets of the band before alone, is no bucket. First
    sets and bands are told by narrow rows, and the sets of those that meet others follow by a join on the row.
    """
    block_rows = block_rows or (SET_ROWS if threshold >= FEW_ABOVE else BLOCK_ROWS)
    rows, by = _buckets(df, by)
    rows = rows.select(F.col(id).cast("long").alias("id"), *by, F.col(tokens).alias("set"))
    form = F.when(F.size("set") > 0, _form(F.col("set"))).otherwise(F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = checkpointed(rows.select("id", *by, "set", F.size("set").alias("n"), form.alias("_form"), F.monotonically_increasing_id().alias("_row")))
    copies = _first_of_equals(rows.drop("set"), by, "n", "_row")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold)) + 1e-9).cast("int") if 0 < threshold < 1 else F.lit(0)
    keys = [*by, "band"]
    spots = copies.filter("id = _first and n > 0").select("_row", *by, "n", band.alias("size")).select(
        "*", F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("band"))
    blocks = F.greatest(block_count(F.count("*"), block_rows), block_count(F.sum("n"), BLOCK_TOKENS))
    crowded = checkpointed(spots.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.count_if(F.col("size") == F.col("band")).alias("_own"), blocks.alias("_blocks")).filter("_n > 1 and _own > 0").drop("_own"))
    places = join_groups(spots, crowded, keys, "_n", 2 * copies.count()).groupBy("_row").agg(
        F.first("size").alias("size"), F.collect_list(F.struct("band", "_blocks")).alias("places"))
    sets = checkpointed(rows.join(places, "_row").select("id", *by, "n", "size", "places", "set"))

    def similar(table: pa.Table) -> Callable:
        return TokenSets(table, "set", "n", "rest", threshold).near

    def run(flagged: DataFrame, some: bool) -> DataFrame:
        placed = flagged.select("*", F.explode("places").alias("_place")).select("*", "_place.*")
        met = (_asked(placed, keys) if some else placed).select(
            *keys, "_blocks", "id", "asks", "stands", "n", (F.col("size") == F.col("band")).alias("own"), (F.col("n") - 1).alias("rest"), "set")
        return Buckets(met, crowded, keys, "_blocks", "id").run(each_cell(_neighbour_lists(similar, listed)), LIST_SCHEMA)

    dropped = _greedy(_scanner(sets, run))
    return _with_copies(dropped, copies, F.lit(1.0))


def pair_text(user: Column, assistant: Column, width: int | None = None) -> Column:
    """What meaning-based deduplication compares: both whole texts, or their first ``width`` characters."""
    both = F.concat(user, F.lit(" \n "), assistant)
    return both if width is None else F.substring(both, 1, width)


def reason(vs: Column, sim: Column) -> Column:
    return F.format_string("semantic_dupe sim=%.3f vs id %d", sim, vs)
