"""Helpers the operators share: reading tables, Arrow text columns, scratch tables, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.session import scratch_path

CHUNK_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
FIRST_ID = -(2**63)  # stands for a null doc_id where an order is needed: it comes first


def shipped(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context; they need not have it installed."""
    context = spark.sparkContext
    if _shipped.get("context") == context.applicationId:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tripweave-"), "tripweave.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    context.addPyFile(archive)
    _shipped["context"] = context.applicationId


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of this session hold about ``BATCH_BYTES``, unless the session bounds their bytes itself.

    By default a batch is 10,000 rows: tens of megabytes of texts, held by the JVM and by a Python worker at once,
    which neither gives back to the system.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of a given table, all of them if none is named."""
    shipped(spark)
    frame = spark.read.parquet(f"{folder}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def settled(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back: lineage ends here."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def pieces(batches: Iterable[pa.RecordBatch], text: int = 1, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Each batch cut into runs of rows whose texts hold about ``limit`` bytes; a longer text is a run of its own."""
    for batch in batches:
        _, bounds = utf8(batch.column(text))
        row = 0
        while row < batch.num_rows:
            stop = int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1
            stop = min(max(stop, row + 1), batch.num_rows)
            yield batch.slice(row, stop - row)
            row = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the offset at which each row starts (and the last ends); null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = column.cast(pa.large_string())
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(wide) + 1, wide.offset * 8)
    stored = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return stored[bounds[0] : bounds[-1]], bounds - bounds[0]


MARKS = 1 << 24  # bits of a set of marks: 512 bitmaps of 4 KB, so it can be sent to every task whatever it marks


def marks(keys: DataFrame) -> DataFrame:
    """A bounded set of marks for the ``key`` (long) of every row: 512 rows of ``bucket, bits`` at most."""
    slot = F.pmod("key", F.lit(MARKS)) + 1
    made = keys.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("position"))
    return settled(made.groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bits")), "marks")


def with_mark(rows: DataFrame, key: Column, marked: DataFrame) -> DataFrame:
    """``rows`` with ``mark``: false only if ``key`` is none of the marked ones.

    It spares what follows the rows that are surely not concerned; others may be marked by chance, the
    more the more keys there are, and an exact step has to follow.
    """
    slot = F.pmod(key, F.lit(MARKS)) + 1
    own = rows.withColumns({"_bucket": F.bitmap_bucket_number(slot), "_position": F.bitmap_bit_position(slot)})
    own = own.join(F.broadcast(marked.withColumnRenamed("bucket", "_bucket")), "_bucket", "left")
    octet = F.conv(F.hex(F.expr("substring(bits, int(_position div 8) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("shiftright(_octet, int(_position % 8)) & 1 = 1")
    own = own.withColumn("_octet", octet).withColumn("mark", F.coalesce(bit, F.lit(False)))
    return own.drop("_bucket", "_position", "_octet", "bits")


def components(links: DataFrame) -> DataFrame:
    """The connected components of ``links`` (``u``, ``v`` long): ``node``, ``component`` (its smallest node).

    Large-star and small-star rounds, each written to the scratch folder; the number of
    rounds grows with the logarithm of the longest chain. A node with very many links is
    reduced to its minimum before the shuffle and is then met in joins that split skew.
    """
    edges = settled(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = _state(edges)
    while before[0]:
        edges = settled(_small_star(_large_star(edges)), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
