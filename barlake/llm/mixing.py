"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length for each source. A source's target becomes a number of
whole passes over it and a remaining budget. A small budget is met by a bounded-knapsack
dynamic program over all counts. A larger one is first filled in proportion to the counts of
every length; then a bounded-knapsack program over changes, documents to be added and taken
ones to be given back, closes the rest. Its window of sums widens until the budget is met,
up to the whole budget, where the program is exhaustive, or to a multiple of the longest text.
Which documents of a length are taken follows from a seeded hash of their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import staged, word_count

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
SEED = 17
# Documents of one source and length are ranked within so many hash ranges.
RANGES = 1024
# Widths, in words, of the dynamic program's windows of sums; the last one is widened to
# LONGEST times the longest text. A window takes five bytes for each of its sums.
WINDOWS = (1 << 15, 1 << 20, 1 << 24)
LONGEST = 8
# One text in so many of a length may change in all windows but the last.
FEW_CHANGED = 50


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MOST_PASSES) -> DataFrame:
    """``sources`` (source, source_size) with ``target`` (double).

    Sources by code point, null last, weigh as ``weights`` repeat. They share the sum of all
    sizes; no target exceeds ``passes`` times its source, and what that leaves is shared by
    the others by weight. In the order of size for each unit of weight the capped sources
    come first, so running sums find where capping ends. One row for each source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    number = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), number % len(weights) + 1)
    weighed = sources.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * passes).cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, rest = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    # What a unit of weight gets if exactly the sources before this one are capped.
    share = (
        F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    shared = weighed.withColumn("share", share)
    final = F.min(F.when(F.col("share") * F.col("weight") <= F.col("cap"), F.struct(
        (F.col("cap") / F.col("weight")).alias("ratio"), "share"))).over(everything)["share"]
    target = F.least(F.col("cap"), F.coalesce(final, F.lit(0.0)) * F.col("weight"))
    return shared.withColumn("target", target).select("source", "source_size", "target")


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many texts of each length to take, so that their lengths sum to ``budget`` as
    closely as possible (the smaller sum of two equally close ones).

    Exhaustive for budgets up to the last window. Beyond it the answer is the closest that
    changes of the proportional choice within that window reach.
    """
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return counts.copy()
    # Sums are multiples of the common divisor: the nearest one is aimed at.
    step = int(np.gcd.reduce(lengths))
    parts, aim = lengths // step, (2 * budget + step - 1) // (2 * step)
    away = lambda taken: abs(int((lengths * taken).sum()) - budget)
    widest = max(WINDOWS[-1], LONGEST * int(parts.max()))
    if aim <= WINDOWS[0]:
        return min(_whole(parts, counts, aim), key=away)
    draw = np.random.default_rng(seed)
    best = _filled(parts, counts, aim, draw.permutation(len(parts)))
    # Another order: texts taken and texts left alternate in it.
    order = draw.permutation(len(parts))
    for width in (*WINDOWS[:-1], widest):
        if int((parts * best).sum()) == aim:
            return best
        if width == widest and aim <= widest:
            return min([best, *_whole(parts, counts, aim)], key=lambda taken: (away(taken), int((lengths * taken).sum())))
        # A smaller sum of two equally close ones comes first.
        # Few texts of each length change, so the mix of lengths stays, unless all are needed.
        most = counts if width == widest else counts // FEW_CHANGED + 1
        changed = _changed(parts, counts, best, aim, width, order, most)
        best = min((best, changed), key=lambda t: (away(t), int((parts * t).sum())))
    return best


def _filled(lengths: np.ndarray, counts: np.ndarray, budget: int, order: np.ndarray) -> np.ndarray:
    """Counts in proportion, rounded down, then one more text of some lengths, in the order
    given, while they fit and much is left."""
    total, small = int((lengths * counts).sum()), WINDOWS[0] // 2
    taken = np.array([int(c) * max(0, budget - small // 2) // total for c in counts], np.int64)
    rest = budget - int((lengths * taken).sum())
    for i in order:
        if rest <= small:
            break
        if counts[i] > taken[i] and lengths[i] <= rest:
            taken[i] += 1
            rest -= int(lengths[i])
    return taken


def _portions(count: int) -> Iterator[int]:
    """1, 2, 4, ... and the rest: sums of them give every number up to ``count``."""
    size = 1
    while count > 0:
        yield min(size, count)
        count -= min(size, count)
        size *= 2


def _whole(lengths: np.ndarray, counts: np.ndarray, budget: int) -> list[np.ndarray]:
    """Bounded knapsack over all sums up to the budget: the counts of the largest sum within
    it and of the smallest beyond it. Stops as soon as the budget is met.

    ``last`` holds the portion that reached a sum first. The smallest sum beyond is reached
    from one within by one more portion, or it would not be the smallest.
    """
    last = np.full(budget + 1, -1, np.int32)
    last[0] = 0
    portions, top = [(0, 0)], 0
    beyond, by = None, (0, 0)
    for i in np.argsort(lengths, kind="stable"):
        length = int(lengths[i])
        for size in _portions(min(int(counts[i]), budget // length + 1)):
            weight = size * length
            # The smallest sum that this portion carries beyond the budget.
            start = max(0, budget + 1 - weight)
            over = np.argmax(last[start : top + 1] >= 0) if start <= top else 0
            if start <= top and last[start + over] >= 0 and (beyond is None or start + over + weight < beyond):
                beyond, by = start + int(over) + weight, (i, size)
                from_sum = start + int(over)
            if weight <= budget:
                high = min(top, budget - weight)
                new = np.flatnonzero((last[: high + 1] >= 0) & (last[weight : weight + high + 1] < 0)) + weight
                last[new] = len(portions)
                top = max(top, int(new[-1])) if len(new) else top
            portions.append((i, size))
            if last[budget] >= 0:
                return [_traced(last, portions, lengths, budget)]
        if length > budget:
            break  # longer ones only go farther beyond
    found = [_traced(last, portions, lengths, top)]
    if beyond is not None:
        more = _traced(last, portions, lengths, from_sum)
        more[by[0]] += by[1]
        found.append(more)
    return found


def _traced(last: np.ndarray, portions: list[tuple[int, int]], lengths: np.ndarray, place: int) -> np.ndarray:
    """The counts whose portions lead to a place; every portion was reached before the next."""
    change = np.zeros(len(lengths), np.int64)
    while last[place]:
        i, size = portions[last[place]]
        change[i] += size
        place -= size * int(lengths[i])
    return change


def _changed(
    lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, budget: int, width: int, order: np.ndarray, at_most: np.ndarray
) -> np.ndarray:
    """Bounded knapsack over changes of ``taken``: portions of texts added or given back, up to
    ``at_most`` of a length either way, as long as the change stays within the window. The
    choice whose sum is closest to the budget."""
    half = width // 2
    aim = half + budget - int((lengths * taken).sum())
    last = np.full(2 * half + 1, -1, np.int32)
    last[half] = 0
    portions, low, high = [(0, 0)], half, half
    if not 0 <= aim <= 2 * half:
        return taken
    for i in order:
        for sign, most in ((1, int(counts[i] - taken[i])), (-1, int(taken[i]))):
            for size in _portions(min(most, int(at_most[i]))):
                weight = sign * size * int(lengths[i])
                a, b = max(low, -min(weight, 0)), min(high, 2 * half - max(weight, 0))
                if a > b:
                    continue
                new = np.flatnonzero((last[a : b + 1] >= 0) & (last[a + weight : b + 1 + weight] < 0)) + a + weight
                last[new] = len(portions)
                portions.append((i, sign * size))
                if len(new):
                    low, high = min(low, int(new[0])), max(high, int(new[-1]))
                if last[aim] >= 0:
                    return taken + _traced(last, portions, lengths, aim)
    reached = np.flatnonzero(last >= 0)
    return taken + _traced(last, portions, lengths, int(reached[np.abs(reached - aim).argmin()]))


def _fit_sources(histogram: DataFrame, seed: int) -> DataFrame:
    """(source, size, passes, extra): one task gets the counts of a source by length."""
    schema = "source string, size long, passes long, extra long"

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        lengths = rows["size"].to_numpy().astype(np.int64)
        order = np.argsort(lengths, kind="stable")  # rows arrive in any order
        lengths, counts = lengths[order], rows["n"].to_numpy().astype(np.int64)[order]
        target, size = rows["target"][0].as_py(), rows["source_size"][0].as_py()
        passes = int(target // size) if size else 0
        extra = fit_counts(lengths, counts, round(target - passes * size), seed)
        sources = pa.array([rows["source"][0].as_py()] * len(lengths), pa.string())
        yield pa.RecordBatch.from_arrays(
            [sources, pa.array(lengths), pa.array(np.full(len(lengths), passes)), pa.array(extra)],
            names=["source", "size", "passes", "extra"],
        )

    return histogram.groupBy("source").applyInArrow(fit, schema)


def mix(
    docs: DataFrame,
    size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    passes: int = MOST_PASSES,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, size, source, source_size, target, times) for every row of ``docs``: the mix
    takes the row ``times`` times, 0 to ``passes``.

    ``size`` is the words of the text unless given; null and empty texts have 0 and are not
    taken. A null source is a source. Repeated rows are rows of their own with the same
    hash: of equal rows any may be taken, the result is the same. Reruns agree.
    """
    sized = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            (word_count(F.col("text")) if size is None else size).alias("size"),
            F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)).alias("draw"),
        ),
        "mix-sizes",
    )
    place = F.shiftrightunsigned("draw", 64 - (RANGES - 1).bit_length()).alias("place")
    ranges = sized.groupBy("source", "size", place).agg(F.count("*").alias("n"))
    ranges = staged(ranges, "mix-ranges")
    histogram = ranges.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aimed = staged(targets(totals, weights, passes), "mix-targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    fitted = histogram.join(aimed, same(histogram, aimed)).select(histogram["source"], "size", "n", "source_size", "target")
    counts = staged(_fit_sources(fitted.filter("size > 0"), seed), "mix-counts")

    # Ranges in hash order: those that fit whole, the one that the count ends in, the rest.
    running = F.sum("n").over(
        Window.partitionBy("source", "size").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    )
    key = same(ranges, counts) & (ranges["size"] == counts["size"])
    placed = (
        ranges.join(counts, key)
        .select(ranges["source"], ranges["size"], "place", "n", "passes", "extra")
        .withColumn("left", F.col("extra") - F.coalesce(running, F.lit(0)))
        .withColumn("left", F.greatest(F.lit(0), F.least("left", "n")))
    )
    plan = staged(placed.select("source", "size", "place", "passes", "n", F.col("left").alias("take")), "mix-plan")
    rows = sized.withColumn("place", place)
    key = same(rows, plan) & (rows["size"] == plan["size"]) & (rows["place"] == plan["place"])
    joined = rows.join(plan, key, "left").select(
        rows["doc_id"], rows["source"], rows["size"], rows["place"], "draw",
        F.coalesce("passes", F.lit(0)).alias("passes"), F.coalesce("take", F.lit(0)).alias("take"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    whole = joined.filter((F.col("take") == 0) | (F.col("take") == F.col("n")))
    cut = joined.filter((F.col("take") > 0) & (F.col("take") < F.col("n")))
    rank = F.row_number().over(Window.partitionBy("source", "size", "place").orderBy("draw", "doc_id"))
    times = whole.withColumn("times", F.col("passes") + (F.col("take") > 0).cast("long")).unionByName(
        cut.withColumn("times", F.col("passes") + (rank <= F.col("take")).cast("long"))
    )
    return times.join(aimed, same(times, aimed)).select(
        "doc_id", "size", times["source"], "source_size", "target", "times"
    )


def repeat_to_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MOST_PASSES, seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it. All columns are
    kept. Rows that share doc_id, source and size are taken together, as often as they are in
    sum: each as often as the others, some once more."""
    times = mix(docs, weights=weights, passes=passes, seed=seed)
    summed = staged(
        times.groupBy("doc_id", "source", "size").agg(F.sum("times").alias("times"), F.count("*").alias("same")),
        "mix-times",
    )
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.withColumn("id", F.col("row.doc_id").cast("long")).withColumn("size", word_count(F.col("row.text")))
    key = (
        rows["id"].eqNullSafe(summed["doc_id"])
        & F.col("row.source").cast("string").eqNullSafe(summed["source"])
        & (rows["size"] == summed["size"])
    )
    joined = rows.join(summed.filter("times > 0"), key).select("row", "id", rows["size"], "times", "same")
    alone = joined.filter("same = 1")
    rank = F.row_number().over(Window.partitionBy("id", "row.source", "size").orderBy(F.xxhash64("row")))
    together = joined.filter("same > 1").withColumn("rank", rank)
    share = F.floor(F.col("times") / F.col("same")) + (F.col("rank") <= F.col("times") % F.col("same")).cast("long")
    every = alone.select("row", "times").unionByName(together.select("row", share.cast("long").alias("times")))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return every.filter("times > 0").select("row", copies).select("row.*")
