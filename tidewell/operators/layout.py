"""Physical layout: clustered rewrites (so row-group statistics skip data) and
partition expiry."""

from __future__ import annotations

from contextlib import contextmanager
from typing import Iterator, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F, types as T

from tidewell.session import list_names, move_path, path_exists, remove_path

KEY_BITS = 63              # the interleaved key is a non-negative long
FILE_BYTES = 256 << 20     # wanted size of an output file
SORT_BYTES = 512 << 20     # rows of one file as they lie in memory, where its task sorts them


def _as_number(c: str, dtype: T.DataType) -> Column:
    """An order-preserving double: times as seconds, strings by their first six bytes."""
    col = F.col(c)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        first = F.rpad(F.substring(F.hex(col), 1, 12), 12, "0")
        return F.conv(first, 16, 10).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        return col.cast("timestamp").cast("double")
    if isinstance(dtype, T.BooleanType):
        return col.cast("int").cast("double")
    return col.cast("double")


def zorder_key(df: DataFrame, cols: Sequence[str], bits: int | None = None) -> Column:
    """Bit-interleaved key of columns scaled to ``bits`` bits each (as many as fit in a long).

    One aggregate computes each column's min and max (two scalars per column);
    the interleaving itself is a plain Column expression, so it is code-generated.
    """
    bits = min(bits or 16, KEY_BITS // len(cols), 31)
    numbers = [_as_number(c, df.schema[c].dataType) for c in cols]
    bounds = df.agg(*[F.min(v).alias(f"lo_{i}") for i, v in enumerate(numbers)],
                    *[F.max(v).alias(f"hi_{i}") for i, v in enumerate(numbers)]).first()
    top = (1 << bits) - 1
    scaled = []
    for i, v in enumerate(numbers):
        lo, hi = bounds[f"lo_{i}"], bounds[f"hi_{i}"]
        span = hi - lo if lo is not None and hi != lo else 1.0
        v = F.coalesce((v - F.lit(lo or 0.0)) / F.lit(span) * top, F.lit(0.0))
        scaled.append(F.least(F.greatest(v, F.lit(0.0)), F.lit(float(top))).cast("long"))
    return _interleave(scaled, bits)


RANK_BITS = 8              # 2^8 ranks a column
SAMPLE_PER_RANK = 64       # sampled values a rank; the sample is bounded by 2^bits times this, whatever the table


def rank_boundaries(df: DataFrame, cols: Sequence[str], bits: int = RANK_BITS) -> dict[str, list]:
    """Per column at most 2^bits - 1 ascending values that cut its rows into parts of about equal size.

    They come from a bottom-k sketch: the rows of the k smallest hashes, k = 2^bits * ``SAMPLE_PER_RANK``, found
    by one scan of the columns in which a task keeps k rows.  The sample only places the boundaries; every row is
    ranked.  Values are compared as Spark compares them, strings whole.  Nulls are left out, and NaN and -0.0
    are as in Spark.  A value that holds many ranks' worth of rows is one boundary.
    """
    k = SAMPLE_PER_RANK << bits
    picked = [F.col(_quoted(c)).alias(f"c{i}") for i, c in enumerate(cols)]
    h = F.xxhash64(F.monotonically_increasing_id())
    sample = df.select(*picked).withColumn("_h", h).orderBy("_h").limit(k).drop("_h")
    out = {}
    for i, c in enumerate(cols):
        # the sample is sorted by Spark, so the order is the one that comparisons in the plan follow
        ranked = sample.select(F.col(f"c{i}").alias("v")).filter("v IS NOT NULL").orderBy("v")
        values = [r["v"] for r in ranked.collect()]
        cuts = [values[len(values) * j // (1 << bits)] for j in range(1, 1 << bits)] if values else []
        out[c] = [v for j, v in enumerate(cuts) if j == 0 or v != cuts[j - 1]]
    return out


def _rank(c: Column, cuts: list, kind: T.DataType, lo: int = 0) -> Column:
    """How many of the cuts are at or below the value: a binary search of nested conditions."""
    if not cuts:
        return F.lit(lo).cast("long")
    mid = len(cuts) // 2
    return F.when(c >= F.lit(cuts[mid]).cast(kind), _rank(c, cuts[mid + 1:], kind, lo + mid + 1)).otherwise(
        _rank(c, cuts[:mid], kind, lo))


def rank_zorder_key(df: DataFrame, cols: Sequence[str], bits: int | None = None) -> Column:
    """Bit-interleaved key of the columns' quantile ranks: skewed numbers and strings that share a prefix spread
    over all bits, where ``zorder_key`` scales linearly and looks at six bytes.  Nulls rank lowest.

    Ranks are spread evenly over the bits, so a column with few distinct values keeps its order from the top bit on.
    """
    bits = min(bits or RANK_BITS, KEY_BITS // len(cols))
    cuts = rank_boundaries(df, cols, bits)
    ranks = []
    for c in cols:
        n = max(1, len(cuts[c]))
        rank = _rank(F.col(_quoted(c)), cuts[c], df.schema[c].dataType)
        ranks.append(F.floor(rank * F.lit((1 << bits) - 1) / F.lit(n)).cast("long"))
    return _interleave(ranks, bits)


def _quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _interleave(numbers: Sequence[Column], bits: int) -> Column:
    key = F.lit(0).cast("long")
    for b in range(bits):
        for j, v in enumerate(numbers):
            bit = F.shiftright(v, b).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(numbers) + j))
    return key


def layout_rewrite(df: DataFrame, path: str, cols: Sequence[str], files: int | None = None, by: str = "linear") -> None:
    """``OPTIMIZE … ZORDER BY`` re-aimed: range-partition and sort so each file
    covers a narrow band of the clustering columns.

    ``files`` is the number of output files; by default it follows the estimated size
    of ``df``, which is exact for stored tables, and the size of its rows in memory: a task sorts the rows
    of one file, and files of rows that compress well hold many.  With several columns ``by`` chooses the interleaved key:
    ``"linear"`` (scaled between minimum and maximum) or ``"rank"`` (quantile ranks, for skewed columns and strings).  The range key carries a
    hash of the whole row after the clustering key, so a single key value holding
    a large share of all rows spans several contiguous files instead of one task.
    """
    files = files or max(1, -(-input_bytes(df) // FILE_BYTES), -(-sort_bytes(df) // SORT_BYTES))
    tiebreak = F.xxhash64(*[F.col(c) for c in df.columns]).alias("_tb")
    if len(cols) == 1:
        key = F.col(cols[0])
        out = (df.withColumn("_tb", tiebreak).repartitionByRange(files, key, "_tb")
               .sortWithinPartitions(key).drop("_tb"))
    else:
        key = {"linear": zorder_key, "rank": rank_zorder_key}[by](df, cols)
        out = df.withColumn("_z", key).withColumn("_tb", tiebreak)
        out = out.repartitionByRange(files, "_z", "_tb").sortWithinPartitions("_z").drop("_z", "_tb")
    out.write.mode("overwrite").parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Size in bytes that the optimizer assumes for a DataFrame: for a scan, that of its files
    (``explain("cost")`` shows the same figure)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def sort_bytes(df: DataFrame) -> int:
    """About the bytes that the rows of a DataFrame take in memory while they are sorted: one aggregate of the row count
    and of the lengths of values without a fixed width (nested values by the length of their text)."""
    fixed = 8 * (len(df.columns) + 2) + 8 * (len(df.columns) // 64 + 1) + 32     # slots, null bits, the sorter's pointers
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    loose = [F.col(_quoted(f.name)) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.col(_quoted(f.name)).cast("string")
             for f in df.schema.fields if not isinstance(f.dataType, plain)]
    sums = [F.sum(F.octet_length(c).cast("long") + 8) for c in loose]
    n, *lengths = df.agg(F.count(F.lit(1)), *sums).first()
    return n * fixed + sum(x or 0 for x in lengths)


def _partition_spec(text: str) -> dict[str, str]:
    """``a=1/b=2`` as a dict; values are unescaped as the catalog escaped them."""
    return {k: unquote(v) for k, v in (p.split("=", 1) for p in text.split("/"))}


DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"    # the catalog's name for the partition of null


def expire_partitions(spark: SparkSession, table: str, part_col: str, keep_from: str,
                      archive_path: str | None = None) -> list[str]:
    """Archive then drop partitions whose ``part_col`` is below ``keep_from``; return the expired values.

    Values are compared in the column's type (9 is below 20 in a number, above it in a string); the
    partition of null never expires.  The table may be partitioned by further columns.  The partition list comes from the
    catalog (metadata, one entry per partition) and all expired partitions go in one
    statement.  The archive is a partition-pruned copy that replaces the partitions it
    holds already, so a run repeated after a failure archives nothing twice.
    """
    specs = [_partition_spec(r[0]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    if specs and part_col not in specs[0]:
        raise ValueError(f"{table} is not partitioned by {part_col}")
    kind = spark.table(table).schema[part_col].dataType
    values = sorted({s[part_col] for s in specs if s[part_col] != DEFAULT_PARTITION})
    typed = lambda c: F.col(c).cast(kind)
    below = spark.createDataFrame([(v, keep_from) for v in values], "v string, keep_from string").filter(
        typed("v") < typed("keep_from")).orderBy(typed("v"), "v")
    expired = [r["v"] for r in below.collect()]
    gone = [s for s in specs if s[part_col] in set(expired)]
    if not expired:
        return []
    if archive_path:
        (spark.table(table).filter(F.col(part_col).isin([F.lit(v).cast(kind) for v in expired]))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*specs[0]).parquet(archive_path))

    def quoted(s: dict[str, str]) -> str:
        values = {k: v.replace("\\", "\\\\").replace("'", "\\'") for k, v in s.items()}
        return "PARTITION (" + ", ".join(f"`{k}` = '{v}'" for k, v in values.items()) + ")"
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(quoted(s) for s in gone))
    return expired


# ---------------------------------------------------------------------------- small files

LIST_SLICES = 256          # a folder's file list is summed up in so many parts
PACK, PACKING = "_tw_pack", "_tw_packing"      # hidden from Spark's readers by the underscore
PACKED = r"^packed-(\d+)-"


def _weight(size: Column, name: Column) -> Column:
    """Bytes a file counts for: its size or, where it was packed, the bytes that went in if they were more."""
    went_in = F.regexp_extract(name, PACKED, 1)
    return F.greatest(size, F.when(went_in != "", went_in.cast("long")).otherwise(F.lit(0).cast("long")))


def plan_packing(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``(file, scanned, folder, group_weight, group)``: the files below half of ``file_bytes``, put together within their folder.

    A folder's small files stand in a line by hash and name; a group is those that begin within the same stretch of
    ``file_bytes``.  Each is below half a stretch, so every group but a folder's last weighs more than half a
    stretch and is not small any more: the next plan finds at most one small file a folder, and groups of one file are
    left out.  Positions are running sums within slices of a folder plus the sums of the slices before,
    so a folder of many millions of files is not summed up in one task.  Only names and sizes are read.  A group's name
    is a digest that depends on its files' names, so groups of two plans never share one.  ``scanned`` is the
    file's path as ``_metadata`` gives it.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    name = F.substring_index("path", "/", -1)
    small = (listed.select(F.col("path").alias("file"), F.col("_metadata.file_path").alias("scanned"),
                           F.expr("left(path, length(path) - length(substring_index(path, '/', -1)) - 1)").alias("folder"),
                           _weight(F.col("length"), name).alias("weight"))
             .filter(F.col("weight") * 2 < file_bytes)
             .withColumn("slice", F.pmod(F.xxhash64("file"), F.lit(LIST_SLICES))))
    before = Window.partitionBy("folder").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = small.groupBy("folder", "slice").agg(F.sum("weight").alias("bytes")).select(
        "folder", "slice", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("folder", "slice").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("weight").over(inside), F.lit(0)) + F.col("offset")
    placed = small.join(offsets, ["folder", "slice"]).withColumn("nr", F.floor(start / F.lit(file_bytes)).cast("long"))
    several = placed.groupBy("folder", "nr").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("group_weight"), F.bit_xor(F.xxhash64("file")).alias("names"),
        F.sum(F.pmod(F.xxhash64(F.lit(1), "file"), F.lit(1 << 40))).alias("names2")).filter("n > 1")
    return placed.join(several, ["folder", "nr"]).select(
        "file", "scanned", "folder", "group_weight", F.sha2(F.concat_ws("/", "folder", "nr", "names", "names2"), 256).alias("group"))


def pack_small_files(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES, schema: T.StructType | None = None) -> tuple[int, int]:
    """Rewrite the small files of a Parquet folder, partitioned or not, into files of about ``file_bytes``; return
    how many files went and how many came.  See ``plan_packing`` for which; no other file is opened.

    The plan and the new files are written beside the data in a hidden folder first, then a marker; only then do new
    files move in and old ones go, group by group.  A run that was cut off before the marker changed nothing,
    one cut off after it is finished by the next call.  Between a group's two steps a reader can see its rows
    twice, so pack while nobody reads.  Rows keep their values; a column that some files lack is null there,
    as a reader that merges schemas sees it.  ``schema`` (of the files, without partition columns) saves
    merging the schemas.  Files without a row count as files; a group of nothing else stays.
    """
    path = path.rstrip("/")
    work = f"{path}/{PACKING}"
    moved = _finish_packing(spark, path)
    if path_exists(spark, work):
        remove_path(spark, work)
    if not _has_files(spark, path):
        return moved
    plan_packing(spark, path, file_bytes).write.parquet(f"{work}/plan")
    plan = spark.read.parquet(f"{work}/plan")
    groups = plan.agg(F.countDistinct("group").alias("n")).first()["n"]
    if not groups:
        remove_path(spark, work)
        return moved
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    data = (reader.schema(schema) if schema else reader.option("mergeSchema", "true")).parquet(path)
    # a condition on the file's own name and size: other files are dropped from the scan before it starts
    small = data.filter(_weight(F.col("_metadata.file_size"), F.col("_metadata.file_name")) * 2 < file_bytes)
    of = plan.select(F.col("scanned").alias(f"{PACK}_file"), F.col("group").alias(PACK))
    rows = small.withColumn(f"{PACK}_file", F.col("_metadata.file_path")).join(of, f"{PACK}_file").drop(f"{PACK}_file")
    # one task, folder and file a group, none of which weighs more than one and a half wanted files
    dealt = rows.join(_numbered(plan), PACK).repartitionById(groups, f"{PACK}_nr").drop(f"{PACK}_nr")
    with _unsorted_writes(spark):
        dealt.write.option("maxRecordsPerFile", 0).partitionBy(PACK).parquet(f"{work}/rows")
    spark.range(1).coalesce(1).write.parquet(f"{work}/done")
    went, came = _finish_packing(spark, path)
    return moved[0] + went, moved[1] + came


def _numbered(plan: DataFrame) -> DataFrame:
    """The groups of a plan numbered from 0 without gaps: places within slices plus the sizes of the slices before."""
    groups = plan.select(F.col("group").alias(PACK)).distinct().withColumn("slice", F.pmod(F.xxhash64(PACK), F.lit(LIST_SLICES)))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # one row a slice
    offsets = groups.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).select(
        "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("slice").orderBy(PACK)) - 1
    return groups.withColumn("place", place).join(offsets, "slice").select(
        PACK, (F.col("place") + F.col("offset")).cast("int").alias(f"{PACK}_nr"))


@contextmanager
def _unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes keep a file open for each value in a task, where else a task first sorts all its rows by it:
    for rows dealt so that a task has one value."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    was = spark.conf.get(key, "0")
    spark.conf.set(key, "2")
    try:
        yield
    finally:
        spark.conf.set(key, was)


def _has_files(spark: SparkSession, path: str) -> bool:
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return path_exists(spark, path) and bool(listed.load(path).select("path").head(1))


def _finish_packing(spark: SparkSession, path: str) -> tuple[int, int]:
    """Move the files of a packing that has its marker to their folders and delete those they replace.

    A step done before is found done: a group's new file is in one of two places, and deleting twice does nothing.
    """
    work = f"{path}/{PACKING}"
    if not any(n.startswith("part-") for n in list_names(spark, f"{work}/done")):
        return 0, 0
    went = came = 0
    # names only, one partition of them at a time in the driver, as when Spark commits the files of a job
    plan = spark.read.parquet(f"{work}/plan")
    target, ready = None, False
    for r in plan.orderBy("group", "file").toLocalIterator():
        wanted = f"{r['folder']}/packed-{r['group_weight']}-{r['group']}.parquet"
        if wanted != target:
            target, source = wanted, f"{work}/rows/{PACK}={r['group']}"
            new = [n for n in list_names(spark, source) if n.startswith("part-")]
            if new and path_exists(spark, target):
                raise FileExistsError(f"{target} is there already; {source} was not moved")
            if new:
                move_path(spark, f"{source}/{new[0]}", target)
            ready = path_exists(spark, target)
            came += ready
        if ready:
            remove_path(spark, r["file"])
            went += 1
    remove_path(spark, f"{work}/done")      # first: what is left without the marker counts as not begun
    remove_path(spark, work)
    return went, came
