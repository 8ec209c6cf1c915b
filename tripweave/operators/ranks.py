"""Exact order statistics per group, without sorting a large group in one task."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tripweave.session import ensure_checkpoints, scratch_path

DIRECT_LIMIT = 2_000_000
BINS = 1024
BROADCAST_BYTES = 64 * 1024 * 1024
SPAN_BYTES = 256  # of a span besides its key
SALTS = 64
SKETCH_SIZE = 4096

Pick = Callable[[Column], Column]


@dataclass(frozen=True)
class Share:
    """The rank of the value that a share of the values lies below, by a rule for its 0-based index."""

    p: float
    index: Pick

    def __call__(self, n: Column) -> Column:
        return self.index(n)


def floor_index(p: float) -> Share:
    """0-based index ``floor(n * p)``."""
    return Share(float(p), lambda n: F.floor(n * F.lit(float(p))))


def discrete_index(p: float) -> Share:
    """0-based index of the smallest value with at least a share ``p`` at or below it."""
    return Share(float(p), lambda n: F.greatest(F.ceil(n * F.lit(float(p))) - 1, F.lit(0)))


def rank_margin(k: int) -> float:
    """How far a rank in a KLL sketch of size ``k`` can be off: four times the error it keeps with 99 %."""
    return 4 * 2.296 / k**0.9021


def bracketed(
    df: DataFrame, values: Sequence[str], picks: Mapping[str, Share], by: Sequence[str] = (), k: int = SKETCH_SIZE
) -> DataFrame:
    """Exact values at given ranks of several columns, from two passes: a lazy plan, no job while it is built.

    One row per group: ``key`` (struct of ``by``) and for each column ``c`` a struct ``c`` with ``size, mean,
    lo, hi`` and one field per pick. The first pass sketches all columns at once; a mergeable sketch gives
    two values that surely lie on either side of each wanted rank. The second counts every value: by itself
    if it is inside a bracket or at its end, else with all others between the same two ends. So at most
    ``2 * rank_margin(k)`` of a group (all of a group of up to ``16 * k`` values) are told apart.

    Sketches are random and may come out otherwise when a task is repeated. That shows in what is
    counted together, not in the result: a rank that falls on values counted together, or cells that overlap,
    are an error and never a wrong value. Nulls are left out; NaN comes last.
    """
    rows = df.select(group_key(by).alias("key"), *[F.col(c).cast("double").alias(c) for c in values])
    facts = rows.groupBy("key").agg(
        *[f(c).alias(f"{c}|{n}") for c in values for n, f in (("size", F.count), ("mean", F.avg), ("lo", F.min), ("hi", F.max))]
    )
    sketched = rows.groupBy(F.col("key").alias("of")).agg(
        *[f(c).alias(f"{c}|{n}") for c in values for n, f in (("size", F.count), ("lo", F.min), ("hi", F.max))],
        *[F.kll_sketch_agg_double(_ordered(F.col(c)), F.lit(k)).alias(f"{c}|sketch") for c in values],
    )
    bounds = sketched.select("of", *_brackets(values, picks, k))
    both = rows.join(bounds, F.col("key") == F.col("of")) if by else rows.crossJoin(F.broadcast(bounds))  # one row
    cells = [_cell(i, c, picks) for i, c in enumerate(values)]
    told = both.select("key", F.inline(F.array(*cells))).where("cell IS NOT NULL")
    tally = told.groupBy("key", "spot", "cell", "kept").agg(F.count("*").alias("n"), F.min("v").alias("first"), F.max("v").alias("last"))
    group = W.partitionBy("key", "spot")
    in_order = group.orderBy("cell", "kept")
    tally = tally.withColumns(
        {
            "upto": F.sum("n").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)),
            "size": F.sum("n").over(group),
            "apart": F.coalesce(F.lag("last").over(in_order) < F.col("first"), F.lit(True)),
        }
    )
    ranked = tally.groupBy("key", "spot").agg(
        *[F.max_by(F.struct("kept"), F.when(_falls_here(pick), F.lit(1))).alias(name) for name, pick in picks.items()],
        F.min("apart").alias("apart"),
    )
    lost = F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")
    whole = {n: F.when(F.col("apart") & F.col(f"`{n}`.kept").isNotNull(), F.col(f"`{n}`.kept")).otherwise(lost) for n in picks}
    wide = ranked.select("key", "spot", *[v.alias(n) for n, v in whole.items()]).groupBy(F.col("key").alias("ranked")).agg(
        *[F.max(F.when(F.col("spot") == i, F.col(f"`{n}`"))).alias(f"{c}|{n}") for i, c in enumerate(values) for n in picks]
    )
    stats = facts.join(wide, F.col("key") == F.col("ranked"), "left")
    fields = ("size", "mean", "lo", "hi", *picks)
    return stats.select("key", *[F.struct(*[F.col(f"`{c}|{n}`").alias(n) for n in fields]).alias(c) for c in values])


def _ordered(v: Column) -> Column:
    """Sketches have no NaN: it counts as infinite there."""
    return F.when(F.isnan(v), F.lit(float("inf"))).otherwise(v)


def _brackets(values: Sequence[str], picks: Mapping[str, Share], k: int) -> list[Column]:
    out, margin = [], rank_margin(k)
    for c in values:
        size, sketch = F.col(f"`{c}|size`"), F.col(f"`{c}|sketch`")
        for name, pick in picks.items():
            for side, share, end in (("low", pick.p - margin, "lo"), ("high", pick.p + margin, "hi")):
                bound = _ordered(F.col(f"`{c}|{end}`"))
                if 0 < share < 1:
                    bound = F.when(size > 16 * k, F.kll_sketch_get_quantile_double(sketch, F.lit(share))).otherwise(bound)
                out.append(bound.alias(f"{c}|{name}|{side}"))
    return out


def _cell(spot: int, c: str, picks: Mapping[str, Share]) -> Column:
    """Where a value lies among the ends of the brackets, and the value itself where it is not counted with others."""
    v, cell, kept = F.col(c), F.lit(0), F.lit(False)
    for name in picks:
        low, high = F.col(f"`{c}|{name}|low`"), F.col(f"`{c}|{name}|high`")
        for end in (low, high):
            cell = cell + (end < v).cast("int") + (end <= v).cast("int")
        kept = kept | ((v >= low) & ((v <= high) | (high == F.lit(float("inf")))))  # NaN comes after an infinite end
    return F.struct(F.lit(spot).alias("spot"), cell.alias("cell"), F.when(kept, v).alias("kept"), v.alias("v"))


def _falls_here(pick: Share) -> Column:
    index = F.least(pick(F.col("size")), F.col("size") - 1)
    return (index >= F.col("upto") - F.col("n")) & (index < F.col("upto"))


def group_key(by: Sequence[str]) -> Column:
    """All grouping columns as one struct, in which null equals null."""
    return F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))


def group_facts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per group with a value: ``key, size, mean, variety, lo, hi, start, stop``.

    From one scan; kept in the checkpoint folder, since several steps read it.
    """
    ensure_checkpoints(df.sparkSession)
    finite = F.when(~F.isnan("v") & (F.abs("v") != F.lit(float("inf"))), F.col("v"))
    return (
        _keyed(df, value, by)
        .groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.avg("v").alias("mean"),
            F.approx_count_distinct("v").alias("variety"),
            F.min("v").alias("lo"),
            F.max("v").alias("hi"),
            F.min(finite).alias("start"),
            F.max(finite).alias("stop"),
        )
        .checkpoint()
    )


def _keyed(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    return df.select(group_key(by).alias("key"), F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")


def order_statistics(
    df: DataFrame,
    value: str,
    picks: Mapping[str, Pick],
    by: Sequence[str] = (),
    direct_limit: int = DIRECT_LIMIT,
    bins: int = BINS,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Values at given ranks: columns ``key`` (struct of ``by``), ``pick`` and ``value``.

    Nulls are left out. Rows are counted per distinct value in every task first. Groups of
    up to about ``direct_limit`` distinct values are then ranked with a window over those
    counts. When a group has more, histogram passes over the data narrow each wanted rank
    down first: every pass splits the value span that holds a rank into ``bins`` parts and
    keeps the part the rank falls in, so only counts are shuffled. A span ends when it
    holds few distinct values. The bounds of a span are the smallest and largest value
    inside it, so the result does not depend on row order or on how tasks are retried;
    distinct values are estimated, which only decides when to stop narrowing. Pass
    ``facts`` to reuse those of ``group_facts``.
    """
    rows = _keyed(df, value, by)
    facts = group_facts(df, value, by) if facts is None else facts
    if (facts.agg(F.max("variety")).first()[0] or 0) <= direct_limit:
        return _direct(rows, picks)
    spans = facts.withColumns({"below": F.lit(0).cast("long"), "wanted": _wanted(picks)}).drop("size", "mean")
    # Every pass reads the values again: written once, whatever made them runs once.
    path = scratch_path(df.sparkSession, "ranks")
    rows.write.parquet(path)
    return _narrowed(df.sparkSession.read.schema(rows.schema).parquet(path), spans.checkpoint(), direct_limit, bins)


def _wanted(picks: Mapping[str, Pick]) -> Column:
    last = F.col("size") - 1
    return F.array(
        *[
            F.struct(F.lit(name).alias("pick"), F.least(pick(F.col("size")), last).alias("idx"))
            for name, pick in picks.items()
        ]
    )


def _running(*keys: str, order: str) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)


def _direct(rows: DataFrame, picks: Mapping[str, Pick]) -> DataFrame:
    """Rank the distinct values of every group with one window."""
    tally = rows.groupBy("key", "v").agg(F.count(F.lit(1)).alias("c"))
    counted = tally.withColumns(
        {"upto": F.sum("c").over(_running("key", order="v")), "size": F.sum("c").over(W.partitionBy("key"))}
    )
    held = _held(_wanted(picks), F.col("upto") - F.col("c"), F.col("c"))
    return counted.select("key", F.explode(held).alias("w"), "v").select("key", "w.pick", F.col("v").alias("value"))


def _narrowed(rows: DataFrame, spans: DataFrame, direct_limit: int, bins: int) -> DataFrame:
    oversized = (F.col("lo") < F.col("hi")) & (F.col("variety") > direct_limit)
    while not (wide := spans.filter(oversized)).isEmpty():
        spans = spans.filter(~oversized).unionByName(_split(rows, wide, bins)).checkpoint()
    settled = spans.filter(F.col("lo") == F.col("hi")).select(
        "key", F.explode("wanted").alias("w"), F.col("lo").alias("value")
    )
    rest = spans.filter(F.col("lo") < F.col("hi"))
    tally = _inside(rows, rest).groupBy("key", "lo", "v").agg(F.count(F.lit(1)).alias("c"))
    ranked = _rank_tally(tally, rest.select("key", "lo", "below", "wanted"))
    return settled.select("key", "w.pick", "value").unionByName(ranked)


def _inside(rows: DataFrame, spans: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows with the span they fall in; spans of one group do not overlap.

    Spans whose measured size allows it are sent to every task. Beyond that both sides are
    shuffled, the rows of a group over many keys, so that a large group is spread.
    """
    side = spans.select(F.col("key").alias("span_key"), "lo", "hi", "start", "stop")
    hit = (F.col("key") == F.col("span_key")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))
    size = side.agg(F.sum(F.octet_length(F.to_json("span_key")) + SPAN_BYTES)).first()[0] or 0
    if size <= (BROADCAST_BYTES if limit is None else limit):
        return rows.join(F.broadcast(side), hit, "inner").drop("span_key")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    copies = side.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return salted.join(copies, hit & (F.col("salt") == F.col("copy")), "inner").drop("span_key", "salt", "copy")


def _split(rows: DataFrame, spans: DataFrame, bins: int) -> DataFrame:
    """Replace each span by the parts of it that hold a wanted rank."""
    v, start, stop = F.col("v"), F.col("start"), F.col("stop")
    infinity = F.lit(float("inf"))
    # Halving first keeps the width of a span finite.
    width = stop / 2 - start / 2
    part = F.floor((v / 2 - start / 2) / width * F.lit(bins))
    part = (
        F.when(F.isnan(v), F.lit(bins + 1))
        .when(v == infinity, F.lit(bins))
        .when(v == -infinity, F.lit(-1))
        .when(width > 0, F.least(part, F.lit(bins - 1)))
        .otherwise((v > start).cast("int"))
    )
    histogram = (
        _inside(rows, spans)
        .groupBy("key", F.col("lo").alias("span_lo"), part.alias("part"))
        .agg(
            F.count(F.lit(1)).alias("c"),
            F.approx_count_distinct("v").alias("variety"),
            F.min("v").alias("new_lo"),
            F.max("v").alias("new_hi"),
        )
    )
    upto = F.sum("c").over(_running("key", "span_lo", order="part"))
    head = spans.select(F.col("key").alias("span_key"), "lo", "below", "wanted")
    placed = (
        histogram.withColumn("upto", upto)
        .join(head, (F.col("key") == F.col("span_key")) & (F.col("span_lo") == F.col("lo")))
        .withColumn("first", F.col("below") + F.col("upto") - F.col("c"))
        .withColumn("wanted", _held(F.col("wanted"), F.col("first"), F.col("c")))
        .filter(F.size("wanted") > 0)
    )
    return placed.select(
        "key",
        "variety",
        F.col("new_lo").alias("lo"),
        F.col("new_hi").alias("hi"),
        F.col("new_lo").alias("start"),
        F.col("new_hi").alias("stop"),
        F.col("first").alias("below"),
        "wanted",
    )


def _held(wanted: Column, first: Column, count: Column) -> Column:
    return F.filter(wanted, lambda w: (w["idx"] >= first) & (w["idx"] < first + count))


def _rank_tally(tally: DataFrame, spans: DataFrame) -> DataFrame:
    """Read the wanted ranks off counted distinct values."""
    upto = F.sum("c").over(_running("key", "lo", order="v"))
    head = spans.select(F.col("key").alias("span_key"), F.col("lo").alias("span_lo"), "below", "wanted")
    hits = (
        tally.withColumn("upto", upto)
        .join(head, (F.col("key") == F.col("span_key")) & (F.col("lo") == F.col("span_lo")))
        .withColumn("w", F.explode(_held(F.col("wanted"), F.col("below") + F.col("upto") - F.col("c"), F.col("c"))))
    )
    return hits.select("key", "w.pick", F.col("v").alias("value"))
