"""Helpers that the operators of this subpackage share: the shared folder, files written by executors, range shards."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Lets workers give what they freed back to the system, instead of holding it for as long as they live.
LEAN = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "4194304", "MALLOC_MMAP_THRESHOLD_": "4194304"}
ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it is not installed but lies on a path that they can read.

    Whole texts go to them in batches of 8 MB at most, unless the session sets another size than Spark's own.
    """
    if spark.conf.get(BATCH_BYTES) == "67108864b":
        spark.conf.set(BATCH_BYTES, "8m")
    own = spark.sparkContext.environment
    path = own.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        own["PYTHONPATH"] = os.pathsep.join(x for x in (path, ROOT) if x)
    for name, value in LEAN.items():
        own.setdefault(name, os.environ.get(name, value))
    return spark


def shared_base(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a local session without that setting gets a folder of its own."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = getattr(sc, "_pageloom_base", None)
        if base is None:
            base = sc._pageloom_base = "file://" + tempfile.mkdtemp(prefix="pageloom-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


_made: list[str] = []  #: the folders of this driver that ``scratch`` may still remove


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new folder under the shared one."""
    _made.append(f"{shared_base(spark)}/{what}-{uuid.uuid4().hex[:12]}")
    return _made[-1]


@contextmanager
def scratch(spark: SparkSession):
    """Removes the folders that were made within the block when it ends or fails."""
    first = len(_made)
    try:
        yield
    finally:
        for uri in _made[first:]:
            path = spark._jvm.org.apache.hadoop.fs.Path(uri)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        del _made[first:]


def cut(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which ends its lineage and keeps it from being computed twice."""
    spark = df.sparkSession
    out = shared_dir(spark, what)
    df.write.parquet(out)
    return spark.read.schema(df.schema).parquet(out)


def filesystem(uri: str):
    """The pyarrow file system of ``uri`` and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def read_file(uri: str) -> bytes:
    store, path = filesystem(uri)
    with store.open_input_file(path) as f:
        return f.read()


class AtomicFile:
    """A file written under a temporary name and renamed when it is whole, so that a lost or repeated task leaves no part of one."""

    def __init__(self, uri: str):
        self.store, self.path = filesystem(uri)
        folder, _, name = self.path.rpartition("/")
        self.store.create_dir(folder, recursive=True)
        self.temporary = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
        self.out = self.store.open_output_stream(self.temporary)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        """Give the file its name; one that an attempt before made has the same content and is replaced."""
        self.out.close()
        try:
            self.store.move(self.temporary, self.path)
        except OSError:  # a store that doesn't replace
            self.store.delete_file(self.path)
            self.store.move(self.temporary, self.path)
        self.temporary = None

    def abort(self) -> None:
        """Remove what was written; nothing if it was committed."""
        if self.temporary:
            self.out.close()
            self.store.delete_file(self.temporary)
            self.temporary = None


def is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is a table of files as it is read, so that every evaluation gives the same rows in the same tasks."""
    return df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"


#: Bits of a row number (``monotonically_increasing_id``) that count the rows of a task; the bits above number the task.
ROW_BITS = 33


def write_lists(entries: DataFrame, what: str) -> str:
    """Write rows of longs, the first of them a row number, as one sorted file of 64-bit integers for each task of the
    numbered rows; the folder's name comes back. With ``Lists`` each such task finds its own entries, so that a choice of
    rows moves numbers and never whole rows.
    """
    spark = prepare(entries.sparkSession)
    out = shared_dir(spark, what)
    first, width = entries.columns[0], len(entries.columns)

    def write(batches):
        import numpy as np

        now, held, done = None, [], 0

        def close():
            f = AtomicFile(f"{out}/{now}")
            f.write(b"".join(held))
            f.commit()

        for b in batches:
            table = np.stack([b.column(k).to_numpy().astype("<i8") for k in range(width)], 1)
            block = table[:, 0] >> ROW_BITS
            for part in np.split(table, np.flatnonzero(np.diff(block)) + 1):
                if len(part):
                    if (own := int(part[0, 0]) >> ROW_BITS) != now:
                        if held:
                            close()
                        now, held = own, []
                    held.append(part.tobytes())
                    done += len(part)
        if held:
            close()
        yield pa.RecordBatch.from_pydict({"n": [done]})

    rows = entries.select(*(F.col(c).cast("long") for c in entries.columns)).where(F.col(first).isNotNull())
    rows.repartition(F.shiftright(first, ROW_BITS)).sortWithinPartitions(*entries.columns).mapInArrow(write, "n long").agg(F.sum("n")).first()
    return out


class Lists:
    """Reads what ``write_lists`` wrote, of one task's rows at a time."""

    def __init__(self, folder: str, width: int):
        self.folder, self.width, self.block, self.held = folder, width, None, None

    def of(self, keys):
        """The entries of these row numbers, which come from one table in its order."""
        import numpy as np

        found = []
        for block in np.unique(keys >> ROW_BITS).tolist():
            if block != self.block:
                from pyarrow import fs

                store, path = filesystem(f"{self.folder}/{block}")
                data = b"" if store.get_file_info(path).type == fs.FileType.NotFound else read_file(f"{self.folder}/{block}")
                self.block, self.held = block, np.frombuffer(data, "<i8").reshape(-1, self.width)
            a, z = np.searchsorted(self.held[:, 0], [keys.min(), keys.max() + 1])
            found.append(self.held[a:z])
        return np.concatenate(found) if found else np.zeros((0, self.width), np.int64)


def range_shard(df: DataFrame, key: str, rows_per_shard: int, size: Column | None = None, bytes_per_shard: int = 1 << 40) -> tuple[Column, int]:
    """An expression that numbers contiguous ranges of the integer column ``key`` from 0, and how many ranges there are.

    Keys are put in order and weighed, a row by the larger of its parts of ``rows_per_shard`` and, with ``size`` in bytes, of
    ``bytes_per_shard``; a range ends where a whole number of shards is full, so that only a single key's rows can
    exceed it. The ranges depend on the keys and sizes alone, not on how the rows are dealt out. Null keys fall in range 0.

    Only the key and the size are shuffled. The driver holds the first key of each range, 8 bytes for all the rows of a shard.
    """
    spark, k = prepare(df.sparkSession), F.col(f"`{key}`").cast("long")
    weight = F.lit(bytes_per_shard) if size is None else F.greatest(F.lit(bytes_per_shard), size.cast("long") * F.lit(rows_per_shard))
    weight, full = weight.cast("decimal(38,0)"), f"cast('{rows_per_shard * bytes_per_shard}' as decimal(38,0))"
    keys = df.select(k.alias("key"), weight.alias("w")).where("key is not null").groupBy("key").agg(F.sum("w").cast("decimal(38,0)").alias("w"))
    keys = cut(keys.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "key").withColumn("part", F.spark_partition_id()), "keys")
    before, starts = 0, []
    for part, w in sorted(keys.groupBy("part").agg(F.sum("w"), F.min("key").alias("least")).orderBy("least").select("part", "sum(w)").collect()):  # a row for each partition
        starts.append((part, str(before)))
        before += int(w)
    if not starts:
        return F.lit(0), 1
    offset = F.from_json(F.lit(json.dumps({str(p): x for p, x in starts})), "map<string,string>")
    own = W.partitionBy("part").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    ranked = keys.withColumn("before", F.coalesce(F.sum("w").over(own), F.lit(0)) + F.element_at(offset, F.col("part").cast("string")).cast("decimal(38,0)"))
    firsts = ranked.select("key", F.expr(f"before div {full}").alias("shard")).groupBy("shard").agg(F.min("key").alias("key")).select("key")
    bounds = sorted(r[0] for r in firsts.collect())  # the first key of each range
    if len(bounds) == 1:
        return F.lit(0), 1
    held = spark.sparkContext.broadcast(bounds)

    def number(keys: pa.Array) -> pa.Array:
        import numpy as np

        return pa.array(np.searchsorted(held.value, keys.to_numpy(), side="right").astype("int32") - 1)

    return F.arrow_udf(number, "int")(F.coalesce(k, F.lit(bounds[0]))), len(bounds)


def leave_out(rows: DataFrame, drop: DataFrame, text_col: str = "text") -> DataFrame:
    """``rows``, a scan of files, without those whose numbers are in ``drop`` (a column key).

    The text's hash goes along, so that a row that is not the one that was numbered raises.
    """
    marks = rows.select(F.monotonically_increasing_id().alias("key"), F.xxhash64(F.col(f"`{text_col}`")).alias("mark"))
    folder = write_lists(marks.join(drop.select("key"), "key", "left_semi"), "drop-lists")

    def run(batches):
        import numpy as np

        lists = Lists(folder, 2)
        for b in batches:
            if b.num_rows:
                keys = b["key"].to_numpy()
                entries = lists.of(keys)
                gone = np.isin(keys, entries[:, 0])
                if not np.array_equal(b["mark"].to_numpy()[gone], entries[:, 1]):
                    raise RuntimeError("the rows are not those that were numbered")
                yield pa.RecordBatch.from_arrays([b["row"].filter(pa.array(~gone))], names=["row"])

    held = rows.select(F.monotonically_increasing_id().alias("key"), F.xxhash64(F.col(f"`{text_col}`")).alias("mark"), F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"))
    return held.mapInArrow(run, held.select("row").schema).select("row.*")


def rows_of(batch, *columns: str, rows: int = 256):
    """The values of these columns row by row; few rows are Python objects at a time, however many whole texts a batch has."""
    for part in slices_of(batch, *columns, rows=rows):
        yield from zip(*part, strict=True)


def slices_of(batch, *columns: str, rows: int = 256):
    """The values of these columns as lists of few rows each."""
    for at in range(0, batch.num_rows, rows):
        yield [batch[c].slice(at, rows).to_pylist() for c in columns]
