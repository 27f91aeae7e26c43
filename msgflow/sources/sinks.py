"""Writers: files, tables, model files, stream sinks and the fan-out of one stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from msgflow.sources.batches import BatchTable
from msgflow.sources.messages import to_json_value

Sink = Callable[[DataFrame, int], None]


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows as JSON lines, text kept in UTF-8."""
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    """CSV with doubled quotes inside quoted fields; spaces at the ends of a field are kept."""
    writer = df.write.mode(mode).option("header", header).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def ensure_table(spark: SparkSession, name: str, ddl: str, path: str | None = None) -> None:
    """Create the target table unless it exists; an existing one is left as it is.

    A table over a folder has the rows of all files under it. What is written batch by batch is read through its
    manifest instead: see `BatchTable.publish`.
    """
    place = f" OPTIONS (recursiveFileLookup 'true') LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{place}")


def write_stream(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None, available_now: bool = False,
    every: str | None = None, partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Append a stream to a parquet folder, exactly once per checkpoint.

    Every query needs a checkpoint of its own.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(writer.option("path", path), available_now, every)


def _start(writer, available_now: bool, every: str | None) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def table_sink(path: str) -> Sink:
    """Batch sink: a `BatchTable`. A replayed batch is not written again, and folders are merged as they become many."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table = BatchTable(batch.sparkSession, path)
        table.append(batch, batch_id)
        table.compact()

    return write


def json_sink(path: str) -> Sink:
    """Batch sink: JSON values, one folder per batch id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        to_json_value(batch).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


def with_key(df: DataFrame, key: list[str], name: str) -> DataFrame:
    """`df` with a text column that names the row: its key columns, each with its length in front, so that no two keys read alike."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in key]
    named = F.concat(*[F.concat(F.length(part).cast("string"), F.lit(":"), part) for part in parts])
    return df.withColumn(name, F.sha2(named, 256))


def once(sink: Sink, log: str) -> Sink:
    """A sink that is not called again for a batch it has finished.

    Finished batches are noted in the folder `log`, one empty file each. A batch whose write was cut short is written
    again as a whole, so the sink behind should name its rows by a key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{log}/{batch_id}")
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            sink(batch, batch_id)
            files.create(place, True).close()

    return write


def kafka_sink(servers: str, topic: str, key: list[str], log: str, data_source: str = "kafka") -> Sink:
    """Batch sink: JSON values to a Kafka topic (needs the Kafka connector on the classpath).

    Records carry the row's key, so that a compacted topic and its readers keep one of each; a finished
    batch is not sent again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns])).alias("value")
        records = with_key(batch, key, "_key").select(F.col("_key").alias("key"), value)
        records.write.format(data_source).mode("append").option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return once(write, log)


def index_sink(resource: str, key: list[str], log: str, options: dict[str, str] | None = None, data_source: str = "es") -> Sink:
    """Batch sink: a search index (needs the index connector on the classpath).

    A row's document is named by its key (column `_key`, which is not stored), so that writing it again replaces it.
    """
    named = {"es.mapping.id": "_key", "es.mapping.exclude": "_key", "es.write.operation": "index"}

    def write(batch: DataFrame, batch_id: int) -> None:
        with_key(batch, key, "_key").write.format(data_source).mode("append").options(**named, **(options or {})).save(resource)

    return once(write, log)


def console_sink(rows: int = 20) -> Sink:
    """Batch sink: the first rows of a batch on standard output."""

    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)

    return write


def write_to_all(batch: DataFrame, batch_id: int, sinks: list[Sink]) -> None:
    """One batch to several sinks, computed once; an empty batch is not written."""
    if len(sinks) > 1:
        batch = batch.persist()
    try:
        if batch.isEmpty():
            return
        for sink in sinks:
            sink(batch, batch_id)
    finally:
        if len(sinks) > 1:
            batch.unpersist()


def fan_out(
    df: DataFrame, sinks: list[Sink], checkpoint: str, name: str | None = None, available_now: bool = False, every: str | None = None
) -> StreamingQuery:
    """One stream to several sinks."""
    writer = df.writeStream.foreachBatch(lambda batch, batch_id: write_to_all(batch, batch_id, sinks))
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return _start(writer, available_now, every)


def save_model(model, path: str, overwrite: bool = False) -> bool:
    """Save a fitted model. False when that fails, such as when it exists and may not be overwritten."""
    try:
        writer = model.write()
        (writer.overwrite() if overwrite else writer).save(path)
        return True
    except Exception as error:  # noqa: BLE001 - the caller only needs to know
        print(f"model not saved to {path}: {type(error).__name__}")
        return False
