"""Zone lookup in the pickup and the dropoff role."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.schemas import EXCLUDED_BOROUGHS

BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1 / 128  # of all trips; so at most 128 ids in a role are hot
ROLES = (("pickup", "PULocationID"), ("dropoff", "DOLocationID"))


@dataclass(frozen=True)
class ZoneFacts:
    """Measured size of a zone table."""

    rows: int
    ids: int
    text_bytes: int

    @property
    def broadcastable(self) -> bool:
        # 64 bytes a row allow for the id, three string headers and the hash slot.
        return self.rows <= BROADCAST_MAX_ROWS and self.text_bytes + 64 * self.rows <= BROADCAST_MAX_BYTES


def measure_zones(zones: DataFrame) -> ZoneFacts:
    """Count rows, ids and bytes in one aggregate; duplicate ids are an error.

    A duplicate id would multiply every trip that refers to it.
    """
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("Borough", "Zone", "service_zone")]
    row = zones.agg(
        F.count("LocationID").alias("rows"),
        F.count_distinct("LocationID").alias("ids"),
        F.coalesce(F.sum(sum(text[1:], text[0])), F.lit(0)).alias("text_bytes"),
    ).first()
    facts = ZoneFacts(row["rows"], row["ids"], row["text_bytes"])
    if facts.rows != facts.ids:
        raise ValueError(f"LocationID is not unique: {facts.rows} rows, {facts.ids} ids")
    return facts


def usable_zones(zones: DataFrame, exclude: Sequence[str] = EXCLUDED_BOROUGHS) -> DataFrame:
    """Zones whose borough is known; a null borough goes too."""
    if not exclude:
        return zones
    return zones.filter(~F.col("Borough").isin(*exclude))


def with_zones(
    trips: DataFrame,
    zones: DataFrame,
    exclude: Sequence[str] = EXCLUDED_BOROUGHS,
    strategy: str = "auto",
    details: bool = False,
    salts: int | Mapping[str, Mapping[int, int]] | None = None,
    facts: ZoneFacts | None = None,
) -> DataFrame:
    """Inner-join the zones twice and add ``pickup_borough`` and ``dropoff_borough``.

    ``auto`` measures the zone table and broadcasts it when it is within the bound;
    beyond that, or with ``merge``, both joins are shuffled. ``broadcast`` insists, and
    fails on a table over the bound. ``details`` also adds ``*_zone`` and
    ``*_service_zone``. Pass ``facts`` to reuse an earlier measurement.

    Shuffled joins read the trips once. A zone of many trips is cut at run time: the sizes that the
    shuffle measures tell the engine which partitions to split (adaptive execution, on by
    default). Where that is off, ``salts`` cuts every zone into so many pieces, or, as ``hot_zones`` gives
    them, the hot zones of each role.
    """
    if strategy not in ("auto", "broadcast", "merge"):
        raise ValueError(f"unknown join strategy {strategy!r}")
    facts = facts or measure_zones(zones)
    if strategy == "broadcast" and not facts.broadcastable:
        raise ValueError(f"zone table too large to broadcast: {facts}")
    broadcast = facts.broadcastable and strategy != "merge"
    lookup = usable_zones(zones, exclude)
    joined = trips
    for role, key in ROLES:
        side = _role_side(lookup, role, details)
        if broadcast:
            joined = joined.join(F.broadcast(side), F.col(key) == F.col(f"{role}_id"), "inner")
        else:
            joined = _salted_merge(joined, side, key, f"{role}_id", salts.get(role, {}) if isinstance(salts, Mapping) else salts or 1)
    return joined.drop(*[f"{role}_id" for role, _ in ROLES])


def _role_side(lookup: DataFrame, role: str, details: bool) -> DataFrame:
    columns = {"LocationID": f"{role}_id", "Borough": f"{role}_borough"}
    if details:
        columns |= {"Zone": f"{role}_zone", "service_zone": f"{role}_service_zone"}
    return lookup.select(*[F.col(old).alias(new) for old, new in columns.items()])


def hot_zones(trips: DataFrame) -> dict[str, dict[int, int]]:
    """Per role the ids of over ``HOT_SHARE`` of the trips, and how many shuffle partitions their share fills.

    For ``salts``, where adaptive execution is off. One job that reads the trips and counts them map-side.
    """
    partitions = int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = F.array(*[F.struct(F.lit(role).alias("role"), F.col(key).cast("long").alias("id")) for role, key in ROLES])
    counts = (
        trips.select(F.explode(ends).alias("end"))
        .select("end.*")
        .groupingSets([["role", "id"], ["role"]], "role", "id")
        .agg(F.grouping("id").alias("all"), F.count("*").alias("n"))
    )
    # a total comes before the ids it adds up, and no more ids than this can be hot
    top = counts.orderBy(F.desc("all"), F.desc("n"), "id").limit(len(ROLES) * (1 + math.ceil(1 / HOT_SHARE))).collect()
    totals = {r["role"]: r["n"] for r in top if r["all"]}
    hot: dict[str, dict[int, int]] = {role: {} for role, _ in ROLES}
    for r in top:
        share = r["n"] / totals[r["role"]]
        if not r["all"] and r["id"] is not None and share > HOT_SHARE:
            hot[r["role"]][r["id"]] = math.ceil(share * partitions)
    return hot


def _salted_merge(trips: DataFrame, side: DataFrame, key: str, side_key: str, salts: int | Mapping[int, int]) -> DataFrame:
    """Sort-merge join in which one zone's trips spread over several shuffle keys.

    ``salts`` is how many for each zone, or a mapping for the hot ones alone. The salt is
    a hash of the row, so a retried task repeats it exactly. Identical rows share a salt;
    AQE's skew-join split handles what they pile up.
    """
    if salts == 1:
        return trips.join(side.hint("merge"), F.col(key) == F.col(side_key), "inner")
    salted = trips.withColumn("_salt", F.pmod(F.xxhash64(*_salt_columns(trips)), _pieces(key, salts)))
    numbers = F.sequence(F.lit(0), _pieces(side_key, salts) - 1).cast("array<bigint>")
    copies = side.withColumn("_copy", F.explode(numbers))
    same: Column = (F.col(key) == F.col(side_key)) & (F.col("_salt") == F.col("_copy"))
    return salted.join(copies.hint("merge"), same, "inner").drop("_salt", "_copy")


def _pieces(key: str, salts: int | Mapping[int, int]) -> Column:
    if isinstance(salts, int):
        return F.lit(salts)
    if not salts:
        return F.lit(1)
    known = F.create_map(*[x for i, n in sorted(salts.items()) for x in (F.lit(i).cast("long"), F.lit(n))])
    return F.coalesce(F.try_element_at(known, F.col(key).cast("long")), F.lit(1))


def _salt_columns(trips: DataFrame) -> list[Column]:
    wanted = ("pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "trip_distance", "total_amount")
    return [F.col(c) for c in wanted if c in trips.columns] or [F.col(c) for c in trips.columns]
