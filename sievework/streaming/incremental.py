"""Validation as files arrive, with exact deduplication against all before.

The structural rules need one record at a time, so they run on the stream as
they are. Copies are found by a state of hashes in the stream: ``without_copies`` drops
them, ``run`` also records the rejected ones and survives a replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.validate import EXACT_COPY, check_records, mark_first_of_hash
from ..sources.readers import RECORD, integrity_issue, parse_chat_lines

WITH_ID = StructType([StructField("id", LongType()), *RECORD.fields])


def line_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Records of the JSON Lines files that land in a folder; they carry an id."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return parse_chat_lines(lines, WITH_ID).withColumn("load_issue", integrity_issue()).drop("fault")


def checked_stream(records: DataFrame) -> DataFrame:
    """Rules one to seven on a stream of records."""
    return check_records(records)


def without_copies(checked: DataFrame, time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Passers with each hash once, first come first kept. The state of hashes is
    bounded only when a time column says how late a copy may come."""
    passers = checked.filter("reason is null")
    if time is None:
        return passers.dropDuplicates(["hash"])
    return passers.withWatermark(time, delay).dropDuplicatesWithinWatermark(["hash"])


#: Keeps the state of hashes on the executors' disks instead of their heaps.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_fresh_hashes(checked: DataFrame) -> DataFrame:
    """The records, and a row with only ``_fresh`` for each hash of a passer that no batch had before.

    The state holds one short row per hash; a batch asks it for its own hashes alone.
    """
    fresh = checked.filter("reason is null").select(F.col("hash").alias("_fresh")).dropDuplicates(["_fresh"])
    return checked.unionByName(fresh, allowMissingColumns=True)


def run(checked: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write ``out/kept`` and ``out/rejected``, one folder per batch.

    Which hashes are new is the stream's state, so a batch costs the same however many came before it and never reads
    what was written. Of a new hash the least id of the batch stays, and a batch replaces its own folder: a replay
    after a failure starts from the state before it and gives the same files.
    """
    spark = checked.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("_row", F.monotonically_increasing_id()).persist()
        fresh = batch.filter("_fresh is not null").select(F.col("_fresh").alias("hash"))
        marked = mark_first_of_hash(batch.filter("_fresh is null").drop("_fresh"))
        # one row of each hash is left to ask for
        seen = marked.filter("reason is null").select("id", "hash").join(fresh, "hash", "left_anti").select("id", F.lit(True).alias("_seen"))
        marked = marked.join(seen, "id", "left")
        marked = marked.withColumn("reason", F.when(F.col("_seen"), EXACT_COPY).otherwise(F.col("reason"))).drop("_seen")
        marked.filter("reason is null").drop("reason").write.mode("overwrite").parquet(f"{out}/kept/batch={number}")
        marked.filter("reason is not null").write.mode("overwrite").parquet(f"{out}/rejected/batch={number}")
        batch.unpersist()

    writer = with_fresh_hashes(checked).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def results(spark: SparkSession, out: str) -> DataFrame:
    """All records of a run so far: ``id, reason, hash``."""
    kept = spark.read.parquet(f"{out}/kept").select("id", F.lit(None).cast("string").alias("reason"), "hash")
    return kept.unionByName(spark.read.parquet(f"{out}/rejected").select("id", "reason", "hash"))
