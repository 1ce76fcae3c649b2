"""Table sources and sinks: snapshots, upserts, incremental reads, partitioning, clustering."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.operators.joins import fits_broadcast, own_shuffle


def work_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors that the cluster names for checkpoints.

    Only a local session, where driver and executors share a disk, may go without.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="clinlake-"))
    return (named or context.getCheckpointDir()).rstrip("/")


#: Codec of the Parquet files. Lineage ids and content hashes are hex texts, which the default codec leaves at their full length.
CODEC = "zstd"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job that begins in the block go when it has ended, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


# -- namespaces and tables ------------------------------------------------------------------

def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def create_view(df: DataFrame, name: str) -> None:
    """Session view over a frame."""
    df.createOrReplaceTempView(name)


def write_overwrite(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Replace a table, its columns included. The frame must not read the table itself.

    With a ``location`` the files go to a folder of the table's name there, else to the
    catalog's warehouse.
    """
    writer = df.write.mode("overwrite").format(fmt).option("overwriteSchema", True)
    if fmt == "parquet":
        writer = writer.option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if location is not None:
        writer = writer.option("path", f"{location}/{table}")
    with shuffles_freed(df.sparkSession):
        writer.saveAsTable(table)


def publish(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    location: str | None = None,
    keep: int = 1,
    properties: dict[str, str] | None = None,
) -> str:
    """Create or replace ``name`` by the content of ``df``, in one step for readers.

    The rows are written to a new snapshot table, then the view ``name`` is pointed at it. A
    write that fails leaves the old content in place, and ``df`` may read ``name``. Snapshots
    older than the ``keep`` previous ones are dropped. ``properties`` become the view's own in the same step; those of
    earlier publishes stay.
    """
    spark = df.sparkSession
    versions = _snapshots(spark, name)
    snapshot = f"{name}__v{(versions[-1][0] if versions else 0) + 1:06d}"
    write_overwrite(df, snapshot, fmt, partition_by, location)
    noted = _noted(spark, name) | (properties or {})
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in noted.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} {f'TBLPROPERTIES ({listed})' if noted else ''} AS SELECT * FROM {snapshot}")
    _drop(spark, versions[: max(0, len(versions) - keep)], location)
    return snapshot


def drop_snapshots(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Drop all snapshots of a name that is not published any more."""
    _drop(spark, _snapshots(spark, name), location)


def _drop(spark: SparkSession, snapshots: list[tuple[int, str]], location: str | None) -> None:
    for _, old in snapshots:
        drop_table(spark, old)
        if location is not None:
            _delete_folder(spark, f"{location}/{old}")


_BATCH_PROPERTY = "clinlake.batch."


def _noted(spark: SparkSession, name: str) -> dict[str, str]:
    """The batches noted with a table or view."""
    if not spark.catalog.tableExists(name):
        return {}
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in found if r["key"].startswith(_BATCH_PROPERTY)}


def last_batch(spark: SparkSession, table: str, stream: str) -> int:
    """The last batch of a stream that the table's content includes; -1 for none."""
    return int(_noted(spark, table).get(_BATCH_PROPERTY + stream, -1))


def _delete_folder(spark: SparkSession, folder: str) -> None:
    """Files of a dropped table with a location of its own, which the catalog leaves."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _snapshots(spark: SparkSession, name: str) -> list[tuple[int, str]]:
    schema, _, base = name.rpartition(".")
    prefix = f"{base}__v"
    listed = spark.catalog.listTables(schema or None, f"{prefix}*")
    numbers = sorted(int(t.name[len(prefix):]) for t in listed if t.name[len(prefix):].isdigit())
    return [(n, f"{schema + '.' if schema else ''}{prefix}{n:06d}") for n in numbers]


# -- upsert and incremental read ---------------------------------------------------------

LINEAGE_ID = "_lineage_id"


def identity(df: DataFrame, key: str) -> Column:
    """What a row is merged by: its key, its lineage id where the key is null; null without either."""
    named = F.concat(F.lit("key "), F.col(key).cast("string"))
    if LINEAGE_ID not in df.columns:
        return named
    return F.coalesce(named, F.concat(F.lit("row "), F.col(LINEAGE_ID)))


def latest_per_key(df: DataFrame, key: str, order: str = "_loaded_at") -> DataFrame:
    """The newest row of every identity; rows without one are all kept.

    A maximum over (order, row) is combined before the shuffle, so a key with very many
    versions never gathers them in one task. All columns take part, which settles ties.
    """
    others = [c for c in df.columns if c != order]
    # One pass for both kinds: a row without an identity is a group by all of its columns, given as often as it came.
    named = df.withColumn("_id", identity(df, key)).withColumn("_row", F.when(F.col("_id").isNull(), F.struct(*df.columns)))
    newest = named.groupBy("_id", "_row").agg(F.max(F.struct(order, *others)).alias("r"), F.count("*").alias("n"))
    times = F.sequence(F.lit(1).cast("bigint"), F.when(F.col("_id").isNull(), F.col("n")).otherwise(1))
    return newest.select("r", F.explode(times)).select("r.*").select(*df.columns)


def staged(df: DataFrame) -> DataFrame:
    """``df`` evaluated once and kept in the checkpoint folder, where executors can be lost."""
    work_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        # A frame of its own: the one given was planned before.
        return df.select("*").checkpoint()


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` evaluated once and kept as compressed Parquet in the shared folder, until the block ends.

    For frames that only one function reads. A checkpoint holds plain rows, several times the size of the same rows in
    Parquet, and stays until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    folder = f"{work_dir(spark)}/kept/{uuid.uuid4().hex}"
    try:
        with shuffles_freed(spark):
            df.write.parquet(folder, compression=CODEC)
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        _delete_folder(spark, folder)


@contextmanager
def kept_latest(df: DataFrame, key: str, order: str = "_loaded_at") -> Iterator[DataFrame]:
    """The rows of ``latest_per_key``, for frames that only one function reads; ``df`` is kept until the block ends.

    Whole rows are shuffled only where the hash of their identity comes more than once. The others are the newest of
    theirs, and told by a count of the hashes alone.
    """
    with ExitStack() as stack:
        rows = stack.enter_context(kept(df))
        named = identity(rows, key)
        hashed = rows.withColumn("_h", F.when(named.isNotNull(), F.xxhash64(named)))
        counted = hashed.filter(F.col("_h").isNotNull()).groupBy("_h").agg(F.count("*").alias("n"))
        several = stack.enter_context(kept(counted.filter("n > 1").select("_h")))
        if several.isEmpty():
            yield rows
        elif fits_broadcast(several):
            several = F.broadcast(several)
            repeated = hashed.join(several, "_h", "left_semi").select(*rows.columns)
            yield hashed.join(several, "_h", "left_anti").select(*rows.columns).unionByName(latest_per_key(repeated, key, order))
        else:
            yield latest_per_key(rows, key, order)


#: A delivery of at most this many rows is broadcast, and the keys of the target are read once more to tell new rows.
#: Beyond it one full join reads the target once.
FEW_ROWS = 10_000


def merge_latest(target: DataFrame, source: DataFrame, key: str, order: str = "_loaded_at") -> DataFrame:
    """The newest row of every identity in the target and the source, whichever of them has it.

    The target holds an identity once, as an upsert leaves it. The source is read for its size and its rows, so it is
    staged first. When it is small it is broadcast and the target is not shuffled.
    """
    return _merged(target, staged(latest_per_key(source, key, order)), key, order)


def _lone(df: DataFrame, key: str, side: str) -> Column:
    """The identity; for rows without one a text of their own, so that they match nothing and no task gets them all."""
    stray = F.concat(F.lit(f"{side} "), F.xxhash64(*df.columns).cast("string"))
    return F.coalesce(own_shuffle(identity(df, key)), stray)


def _winner(columns: Sequence[str], order: str) -> Column:
    """Of two versions ``t`` and ``s`` of a row the newer one; all columns take part, which settles ties."""
    others = [c for c in columns if c != order]
    version = lambda side: F.struct(F.col(f"{side}.{order}"), *[F.col(f"{side}.{c}") for c in others])
    beaten = F.col("t").isNull() | (F.col("s").isNotNull() & (version("s") > version("t")))
    return F.when(beaten, F.col("s")).otherwise(F.col("t"))


def _merged(target: DataFrame, newest: DataFrame, key: str, order: str = "_loaded_at") -> DataFrame:
    columns = target.columns
    old = target.select(_lone(target, key, "t").alias("_k"), F.struct(*columns).alias("t"))
    new = newest.select(_lone(newest, key, "s").alias("_k"), F.struct(*columns).alias("s"))
    winner = _winner(columns, order).alias("r")
    if not fits_broadcast(newest, max_rows=FEW_ROWS):
        return old.join(new, "_k", "full_outer").select(winner).select("r.*")
    kept = old.join(F.broadcast(new), "_k", "left").select(winner).select("r.*")
    known = target.select(_lone(target, key, "t").alias("_k")).join(F.broadcast(new.select("_k")), "_k", "left_semi")
    return kept.unionByName(new.join(F.broadcast(known), "_k", "left_anti").select("s.*"))


def upsert(
    df: DataFrame, table: str, key: str, fmt: str = "parquet", location: str | None = None, batch: tuple[str, int] | None = None
) -> None:
    """Insert new rows and replace older ones of the same identity; creates the table on first use.

    A delivery that comes again, or late, changes nothing that is newer. A format with a transaction log merges in place. A plain one gets a new snapshot, unless
    there is nothing to merge; ``upsert_buckets`` rewrites the touched part of a plain table only.

    ``batch`` names a stream and its batch. A plain table notes it in the step that shows the new snapshot, so a batch
    that is run again is known for sure and not even read. On a logged format the merge is repeated, which changes nothing.
    """
    spark = df.sparkSession
    logged = fmt == "delta"
    noted = None
    if batch is not None and not logged:
        if last_batch(spark, table, batch[0]) >= batch[1]:
            return
        noted = {_BATCH_PROPERTY + batch[0]: str(batch[1])}
    if not spark.catalog.tableExists(table):
        with kept_latest(df, key) as first:
            if logged:
                write_overwrite(first, table, fmt, location=location)
            else:
                publish(first, table, fmt, location=location, properties=noted)
    elif logged:
        latest_per_key(df, key).createOrReplaceTempView("_upsert_source")
        spark.sql(merge_statement(table, "_upsert_source", key, LINEAGE_ID in df.columns))
    else:
        with kept_latest(df, key) as newest:
            if not newest.isEmpty():
                publish(_merged(spark.table(table), newest, key), table, fmt, location=location, properties=noted)


def merge_statement(table: str, source: str, key: str, with_lineage: bool) -> str:
    """The MERGE of a format with a transaction log. One equality of identities, so that it is planned as an equi-join."""
    named = "concat('key ', cast({0}.{1} as string))"
    if with_lineage:
        named = f"coalesce({named}, concat('row ', {{0}}.{LINEAGE_ID}))"
    return (
        f"MERGE INTO {table} t USING {source} s ON {named.format('t', key)} = {named.format('s', key)} "
        "WHEN MATCHED AND s._loaded_at >= t._loaded_at THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


# -- upsert by buckets ---------------------------------------------------------------------

BUCKET = "_bucket"
BUCKETS = 256
#: Steps in which a delivery that is not broadcast rewrites its buckets.
STEPS = 4
_BUCKETS_PROPERTY = "clinlake.buckets"


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows with the number of their bucket: a hash of their identity, of the whole row where they have none."""
    named = identity(df, key)
    hashed = F.when(named.isNull(), F.xxhash64(*df.columns)).otherwise(F.xxhash64(named))
    return df.withColumn(BUCKET, F.pmod(hashed, F.lit(buckets)).cast("int"))


def upsert_buckets(
    df: DataFrame,
    table: str,
    key: str,
    buckets: int = BUCKETS,
    location: str | None = None,
    order: str = "_loaded_at",
    gone: DataFrame | None = None,
) -> list[int]:
    """Upsert that reads and rewrites only the buckets a delivery has rows for; gives their numbers.

    Rows whose identity is in ``gone`` (the key and lineage columns are enough) are taken out of the table.

    The table is stored by hash buckets of the identity. The touched ones are read once, merged, written to the shared
    folder and then put in place of the old ones; files of other buckets stay as they are. A run that ends between the
    two is finished by the next one, from the folder. A large delivery takes the buckets in ``STEPS`` such steps, so that
    no more than a share of the table is in flight. Readers between them may see old and new buckets side by side,
    each of them whole. The number of buckets is kept with the table.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        with kept_latest(df, key, order) as first:
            dealt = with_bucket(first, key, buckets).repartition(BUCKET)
            write_overwrite(dealt, table, partition_by=[BUCKET], location=location)
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_BUCKETS_PROPERTY}' = '{buckets}')")
        return [r[0] for r in spark.table(table).select(BUCKET).distinct().orderBy(BUCKET).collect()]
    _finish(spark, table)
    buckets = int(spark.sql(f"SHOW TBLPROPERTIES {table} ('{_BUCKETS_PROPERTY}')").first()["value"])
    with kept_latest(df, key, order) as newest:
        return _rewrite_buckets(df, with_bucket(newest, key, buckets), table, key, buckets, order, gone)


def _rewrite_buckets(
    df: DataFrame, newest: DataFrame, table: str, key: str, buckets: int, order: str, gone: DataFrame | None
) -> list[int]:
    """Merge the newest rows of a delivery into their buckets, without the rows that are gone."""
    spark = df.sparkSession
    numbers = newest.select(BUCKET)
    with ExitStack() as stack:
        if gone is not None:
            lineage = [LINEAGE_ID] if LINEAGE_ID in df.columns else []
            gone = stack.enter_context(kept(with_bucket(gone.select(key, *lineage).distinct(), key, buckets)))
            numbers = numbers.unionByName(gone.select(BUCKET))
        # At most as many numbers as there are buckets.
        touched = [r[0] for r in numbers.distinct().orderBy(BUCKET).collect()]
        steps = 1 if fits_broadcast(newest) else min(STEPS, len(touched))
        for step in range(steps):
            some = touched[step::steps]
            if some:
                _rewrite_some(newest, table, key, order, gone, some)
    return touched


def _rewrite_some(newest: DataFrame, table: str, key: str, order: str, gone: DataFrame | None, touched: list[int]) -> None:
    spark = newest.sparkSession
    mine = F.col(BUCKET).isin(touched)
    held = spark.table(table).filter(mine)
    if gone is not None:
        names = gone.filter(mine).select(own_shuffle(identity(gone, key)).alias("_k"))
        names = F.broadcast(names) if fits_broadcast(names) else names
        held = held.withColumn("_k", own_shuffle(identity(held, key))).join(names, "_k", "left_anti").drop("_k")
    merged = _merged(held, newest.filter(mine).select(*held.columns), key, order)
    listed = f"{_pending(spark, table)}-touched"
    _delete_folder(spark, listed)
    if gone is not None:
        spark.createDataFrame([(n,) for n in touched], f"{BUCKET} int").coalesce(1).write.parquet(listed)
    with shuffles_freed(spark):
        pending = merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET)
        pending.parquet(_pending(spark, table), compression=CODEC)
    _finish(spark, table)


def _pending(spark: SparkSession, table: str) -> str:
    return f"{work_dir(spark)}/pending/{table}"


def _finish(spark: SparkSession, table: str) -> None:
    """Put the merged buckets that a run has left in the shared folder in place of the old ones."""
    folder = _pending(spark, table)
    if not _exists(spark, f"{folder}/_SUCCESS"):
        return
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        columns = spark.table(table).columns
        pending = spark.read.schema(spark.table(table).schema).parquet(folder)
        with shuffles_freed(spark):
            pending.select(*columns).repartition(BUCKET).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
    if _exists(spark, f"{folder}-touched/_SUCCESS"):
        # An overwrite by partition leaves the buckets it has no rows for: those that have lost all of theirs go.
        left = {r[0] for r in pending.select(BUCKET).distinct().collect()}
        for (n,) in spark.read.parquet(f"{folder}-touched").collect():
            if n not in left:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BUCKET} = {n})")
        _delete_folder(spark, f"{folder}-touched")
    _delete_folder(spark, folder)


def _exists(spark: SparkSession, file: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def since_watermark(df: DataFrame, target: DataFrame | None, column: str = "_loaded_at") -> DataFrame:
    """Rows newer than anything in the target; all of them while it is absent or empty.

    For one load after the other. Loads that overlap need ``not_consumed``.
    """
    if target is None:
        return df
    highest = target.agg(F.max(column)).scalar()
    return df.filter(F.col(column) > F.coalesce(highest, F.lit("0001-01-01").cast("timestamp")))


def not_consumed(df: DataFrame, target: DataFrame | None) -> DataFrame:
    """Rows of landed files of which the target holds no row, whatever their load's time stamp.

    A file lands in one commit and is consumed in one, so files decide, not rows. A file whose
    rows were all replaced by newer ones is read again, which changes nothing in an upsert.
    """
    if target is None:
        return df
    landed = ["_source_file", "_loaded_at"]
    fresh = staged(df.select(*landed).distinct().join(target.select(*landed).distinct(), landed, "left_anti"))
    if fits_broadcast(fresh):
        fresh = F.broadcast(fresh)
    return df.join(fresh, landed, "left_semi").select(*df.columns)


def target_or_none(spark: SparkSession, table: str) -> DataFrame | None:
    return spark.table(table) if spark.catalog.tableExists(table) else None


# -- layout -----------------------------------------------------------------------------

def partition_by_year(df: DataFrame, date: str | Column, name: str = "year_start") -> DataFrame:
    return df.withColumn(name, F.year(date))


def cluster_by_keys(df: DataFrame, columns: Sequence[str], partition: str | None = None, tie: str = "_lineage_id") -> DataFrame:
    """Rows ranged and sorted by the columns, so that a scan for one person reads few files.

    The partition column leads, so that a task writes to few folders. ``tie`` closes the
    range key: without it all rows of one person and day would have to share a task.
    """
    by = ([partition] if partition else []) + list(columns) + ([tie] if tie in df.columns else [])
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def z_order(df: DataFrame, columns: Sequence[str], bits: int = 8, tie: str = LINEAGE_ID) -> DataFrame:
    """Rows ranged and sorted along a Z-curve over the columns, so that a filter on any one of them reads few files.

    Each column becomes the number of its quantile, so that skewed values spread evenly, and the bits of these numbers
    are interleaved. The quantiles are approximate, at most 2^bits a column, of a hash for texts; equal values share a number. Nulls come first.
    """
    steps = [i / 2**bits for i in range(1, 2**bits)]
    # One pass for the quantiles of all columns.
    quantiles = df.agg(*[F.percentile_approx(_sortable(df, c), steps, 10_000).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    ranks = {}
    for c, bounds in zip(columns, quantiles):
        cuts = F.array(*[F.lit(float(b)) for b in sorted(set(bounds))]) if bounds else F.array().cast("array<double>")
        ranks[c] = _below(cuts, _sortable(df, c))
    names = [f"_rank_{i}" for i in range(len(columns))]
    ranked = df.withColumns(dict(zip(names, ranks.values())))
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, n in enumerate(names):
            one = F.shiftright(F.col(n), bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(one, bit * len(names) + len(names) - 1 - i))
    by = ["_z", *([tie] if tie in df.columns else [])]
    return ranked.withColumn("_z", z).drop(*names).repartitionByRange(*by).sortWithinPartitions(*by).drop("_z")


def _below(cuts: Column, value: Column) -> Column:
    """How many of the cuts a value has reached; 0 for a null."""
    return F.coalesce(F.size(F.filter(cuts, lambda cut: cut <= value)), F.lit(0))


def _sortable(df: DataFrame, column: str) -> Column:
    """A column as a number: dates and times by their place in time, texts by their hash."""
    kind = df.schema[column].dataType.typeName()
    if kind in ("string", "char", "varchar", "binary", "boolean"):
        return F.when(F.col(column).isNotNull(), F.xxhash64(column)).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")
