"""Complete streaming jobs put together from the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.boundary import dedup_last, multicast
from ..operators.matching import match_as_of
from ..operators.quality import filter_valid_cell, rekey
from ..operators.skew import partition_band_counts
from ..operators.state import latest_by
from ..session import ROCKSDB_PROVIDER, discard, scratch_path
from ..sources.writers import start
from .processors import dedup_stream

IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state with timers needs the RocksDB store."""
    spark.conf.set(STATE_PROVIDER, ROCKSDB_PROVIDER)


def process_pings(pings: DataFrame, order: str, cell: str = "cell") -> tuple[DataFrame, DataFrame]:
    """(forwarded, state) of the pings whose cell is valid.

    Every valid ping is forwarded keyed by its cell, without a shuffle.  The
    state holds the last ping of each driver; as a streaming aggregate it
    combines rows before they travel and stays inside the JVM.
    """
    valid = filter_valid_cell(pings, cell)
    others = [c for c in valid.columns if c != "driver_id"]
    last = valid.groupBy("driver_id").agg(F.max_by(F.struct(*others), order).alias("__row"))
    return rekey(valid, cell), last.select("driver_id", "__row.*")


def process_to_tables(pings: DataFrame, order: str, base: str, cell: str = "cell", every: str | None = None) -> StreamingQuery:
    """Both outcomes of ``process_pings`` from one query, which reads its source once.

    A batch writes what it forwards to ``<base>/forwarded``, in a folder named by
    the batch, and makes the state of its drivers out of these rows.
    ``driver_state`` reads the state.
    """
    state = _Generations(base, ["driver_id"], _newest_driver, FAN, BUCKETS)

    def on_batch(batch: DataFrame, number: int) -> None:
        forwarded = rekey(filter_valid_cell(batch, cell), cell)
        path = f"{base}/forwarded/batch={number}"
        forwarded.write.mode("overwrite").parquet(path)
        written = batch.sparkSession.read.schema(forwarded.schema).parquet(path)
        state.leave(latest_by(written.select(*batch.columns), ["driver_id"], order), batch.schema, number)

    return start(pings.writeStream.foreachBatch(on_batch), f"{base}/progress", every)


def driver_state(spark: SparkSession, base: str, schema: T.StructType, batches: int) -> DataFrame:
    """The last valid ping of each driver after the first ``batches`` batches of ``process_to_tables``."""
    state = _Generations(base, ["driver_id"], _newest_driver, FAN, BUCKETS)
    return _newest_driver(state.read(spark, covering(batches), schema).drop(BUCKET)).drop(NUMBER)


def boundary_stream(pings: DataFrame, order: str = "event_id", ttl_ms: int | None = None) -> DataFrame:
    """Multicast near borders, then drop the copies again per driver."""
    return dedup_stream(multicast(pings), order=[order, "copy_no"], ttl_ms=ttl_ms)


def band_counts_stream(pings: DataFrame, partitioner: str, every: str | None, sink: Callable[[DataFrame, int], None],
                       checkpoint: str):
    """Cumulative counts per partition and latitude band, emitted in full at every trigger."""
    counts = partition_band_counts(pings, partitioner)
    return start(counts.writeStream.outputMode("complete").foreachBatch(sink), checkpoint, every)


Step = Callable[[DataFrame], DataFrame]
FAN = 8  # state folders that are merged into one
BUCKETS = 8  # files of a state folder
NUMBER, BUCKET = "__batch", "__bucket"


def covering(number: int, fan: int = FAN) -> list[tuple[int, int]]:
    """The state folders (level, last batch) that hold all batches before ``number``, at most ``fan - 1`` of each level."""
    out, upto, level = [], 0, 0
    while fan ** (level + 1) <= number:
        level += 1
    for at in range(level, -1, -1):
        while upto + fan ** at <= number:
            upto += fan ** at
            out.append((at, upto - 1))
    return out


class _Generations:
    """What batches leave behind, in folders by level: ``fan`` of a level become one of the next, the latest row of each key.

    A folder is named by its level and its last batch and written whole, so a
    batch that is repeated after a failure replaces what it had written.  Folders
    that have been merged go when the batch that merged them is known to be over.
    Rows lie in buckets by key; a batch opens those of its keys only.
    """

    def __init__(self, base: str, keys: list[str], latest: Step, fan: int, buckets: int):
        self.base, self.keys, self.latest, self.fan, self.buckets = base, keys, latest, fan, buckets

    def path(self, level: int, last: int) -> str:
        return f"{self.base}/state/{level}-{last}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession, folders: list[tuple[int, int]], schema: T.StructType) -> DataFrame:
        fields = [*schema.fields, T.StructField(NUMBER, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
        reader = spark.read.schema(T.StructType(fields)).option("recursiveFileLookup", "false")
        return reduce(DataFrame.unionByName, [reader.parquet(self.path(*f)) for f in folders])

    def before(self, batch: DataFrame, number: int) -> DataFrame:
        """The latest remembered row of each key of the batch."""
        asked = batch.select(*[F.col(k).alias(f"__{k}") for k in self.keys], self.bucket().alias("__asked")).distinct()
        left = self.read(batch.sparkSession, covering(number, self.fan), batch.schema)
        mine = left.join(asked, [F.col(BUCKET) == F.col("__asked"), *[F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys]], "left_semi")
        return self.latest(mine.drop(BUCKET)).drop(NUMBER)

    def write(self, rows: DataFrame, level: int, last: int) -> None:
        placed = rows.withColumn(BUCKET, self.bucket())
        placed.repartition(self.buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self.path(level, last))

    def leave(self, rows: DataFrame, schema: T.StructType, number: int) -> None:
        spark = rows.sparkSession
        for level, last in self.merged(number - 1):
            discard(spark, self.path(level, last))
        self.write(rows.withColumn(NUMBER, F.lit(number).cast("long")), 0, number)
        for level in self.full(number):
            parts = [(level - 1, number - i * self.fan ** (level - 1)) for i in range(self.fan)]
            self.write(self.latest(self.read(spark, parts, schema).drop(BUCKET)), level, number)

    def full(self, number: int) -> list[int]:
        """Levels that a batch completes."""
        out = []
        while (number + 1) % self.fan ** (len(out) + 1) == 0:
            out.append(len(out) + 1)
        return out

    def merged(self, number: int) -> list[tuple[int, int]]:
        """The folders that a batch has merged into others."""
        if number < 0:
            return []
        return [(level - 1, number - i * self.fan ** (level - 1)) for level in self.full(number) for i in range(self.fan)]


def _in_batches(rows: DataFrame, base: str, every: str | None, answer: Step, remember: Step, latest: Step, keys: list[str],
                fan: int = FAN, buckets: int = BUCKETS) -> StreamingQuery:
    """Run ``answer`` over each micro-batch together with what earlier batches left behind.

    A batch leaves what ``remember`` returns of its own rows, and takes the
    ``latest`` remembered row of each of its keys.  The number of folders that it
    reads grows with the logarithm of the number of batches.  Remembered rows are
    told by ``remembered`` and may have any order number.  Answers go to
    ``<base>/out`` in folders named by batch.
    """
    state = _Generations(base, keys, latest, fan, buckets)

    def on_batch(batch: DataFrame, number: int) -> None:
        together = batch.withColumn("remembered", F.lit(False))
        if number > 0:
            together = together.unionByName(state.before(batch, number).select(*batch.columns, F.lit(True).alias("remembered")))
        answer(together).write.mode("overwrite").parquet(f"{base}/out/batch={number}")
        state.leave(remember(batch), batch.schema, number)

    return start(rows.writeStream.foreachBatch(on_batch), f"{base}/progress", every)


FRESH = "__fresh"  # orders remembered rows before those of the batch


def _with_fresh(rows: DataFrame) -> DataFrame:
    return rows.withColumn(FRESH, (~F.col("remembered")).cast("int"))


def match_in_batches(union: DataFrame, base: str, available: bool = True, every: str | None = None) -> StreamingQuery:
    """The same-cell match of a stream with batch operators, which split crowded cells."""
    def drivers(rows: DataFrame) -> DataFrame:
        return latest_by(rows.filter("kind = 'driver'"), ["cell"], "arrival")

    # a later batch is later, whatever its arrival numbers
    newest = lambda rows: _newest(rows, ["cell"])
    return _in_batches(union, base, every, lambda rows: match_as_of(_with_fresh(rows), available, [FRESH, "arrival"]), drivers, newest, ["cell"])


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of each key from its last batch."""
    return latest_by(rows, keys, NUMBER)


def _newest_driver(rows: DataFrame) -> DataFrame:
    return _newest(rows, ["driver_id"])


def dedup_in_batches(rows: DataFrame, base: str, order: str = "event_id", ts: str = "ts_ms", key: str = "driver_id",
                     every: str | None = None, fan: int = FAN) -> StreamingQuery:
    """Streaming dedup with batch operators, which split a driver who sends very many pings."""
    def fresh(both: DataFrame) -> DataFrame:
        kept = dedup_last(_with_fresh(both), [FRESH, order], ts, key)
        return kept.filter("NOT remembered").drop("remembered", FRESH)

    return _in_batches(rows, base, every, fresh, lambda batch: latest_by(batch, [key], order), lambda left: _newest(left, [key]), [key], fan)


@contextmanager
def _idle_batches(spark: SparkSession, wanted: bool) -> Iterator[None]:
    before = spark.conf.get(IDLE_BATCHES)
    spark.conf.set(IDLE_BATCHES, str(wanted).lower())
    try:
        yield
    finally:
        spark.conf.set(IDLE_BATCHES, before)


def _finish(query: StreamingQuery, every: str | None) -> None:
    """Waits until everything available is processed; a timed query is then stopped."""
    if every is None:
        query.awaitTermination()
        return
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def run_to_table(stream: DataFrame, label: str, mode: str = "append", idle_batches: bool = True, every: str | None = None,
                 base: str | None = None) -> DataFrame:
    """Process everything available and return what the stream wrote.

    State that expires by wall clock always asks for one more batch, so such a
    stream only comes to an end with ``idle_batches=False``.

    Append streams write one table exactly once.  Update and complete streams
    write every micro-batch to a folder named by its number, so a repeated
    batch replaces itself; rows carry that number as ``batch``.  With ``every``
    a batch starts at each such interval.
    """
    spark = stream.sparkSession
    use_rocksdb(spark)
    base = base or scratch_path(spark, label)
    out, checkpoint = f"{base}/out", f"{base}/progress"
    if mode == "append":
        writer = stream.writeStream.outputMode("append").format("parquet").option("path", out)
        with _idle_batches(spark, idle_batches):
            _finish(start(writer, checkpoint, every), every)
        return spark.read.schema(stream.schema).parquet(out)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    with _idle_batches(spark, idle_batches):
        _finish(start(stream.writeStream.outputMode(mode).foreachBatch(write), checkpoint, every), every)
    return spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])).parquet(out)


def live_state(spark: SparkSession, checkpoint: str, variable: str, batches: int) -> DataFrame:
    """batch and the key and value of everything that a stream's state held after each of its first ``batches`` batches."""
    def after(number: int) -> DataFrame:
        reader = spark.read.format("statestore").option("batchId", number).option("stateVarName", variable)
        return reader.load(checkpoint).select(F.lit(number).alias("batch"), "key.*", "value.*")

    return reduce(DataFrame.unionByName, [after(n) for n in range(batches)])
