"""Base tables: read (S2) and write.

Targets are either catalog table names or folder paths.  The load patterns in
``loadwright.plans`` only build DataFrames; these functions are the only ones
that write.

Partitioned writes ask for a ``REBALANCE`` shuffle on the partition columns
first: adaptive execution then splits a partition value that holds a large
share of the rows over several tasks and merges small ones, so no one task
writes a hot partition alone and no task opens a file in every partition.
Unpartitioned writes keep the plan's own partitions (input splits, or
shuffle partitions already sized by adaptive execution) unless
``rebalance=True`` asks for the extra shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadwright.session import scratch_path, scratch_table_name
from loadwright.sources import swaps

DEFAULT_FORMAT = "orc"


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def table_layout(spark: SparkSession, target: str) -> dict:
    """Storage layout of a catalog table: format, partition columns and
    bucketing (``buckets``, ``bucket_by``, ``sort_by``), so a rewrite keeps it."""
    cols = spark.catalog.listColumns(target)
    info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()}

    def names(text):
        return [c.strip().strip("`") for c in (text or "").strip("[]").split(",") if c.strip()]

    return {
        "format": (info.get("Provider") or DEFAULT_FORMAT).lower(),
        "partition_by": [c.name for c in cols if c.isPartition],
        "buckets": int(info["Num Buckets"]) if info.get("Num Buckets") else None,
        "bucket_by": [c.name for c in cols if c.isBucket],
        "sort_by": names(info.get("Sort Columns")),
    }


def external_location(spark: SparkSession, target: str) -> str | None:
    """Folder of an external catalog table; None for a managed one."""
    info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()}
    return info.get("Location") if info.get("Type") == "EXTERNAL" else None


def _location(spark: SparkSession, target: str) -> str | None:
    return {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()}.get("Location")


def table_properties(spark: SparkSession, target: str) -> dict[str, str]:
    """The properties a user (or a stream) set on a catalog table."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect()}
    return {k: v for k, v in props.items() if not k.startswith(("spark.sql.", "option.")) and k not in _STORE_PROPERTIES}


# Properties the metastore maintains itself.
_STORE_PROPERTIES = {"EXTERNAL", "transient_lastDdlTime", "numFiles", "numRows", "rawDataSize", "totalSize", "TRANSLATED_TO_EXTERNAL", "external.table.purge", "bucketing_version"}


def recover(spark: SparkSession, target: str) -> str | None:
    """Finish or undo a swap of ``target`` that was cut (see ``swaps``); every
    load does this first."""
    return swaps.recover(spark, target, _location)


def _prepare(
    df: DataFrame,
    partition_by: Sequence[str] | None,
    rebalance: bool | None,
    buckets: int | None = None,
    bucket_by: Sequence[str] | None = None,
) -> DataFrame:
    """``rebalance=None``: only for partitioned writes.  A bucketed write is
    hash-partitioned on the bucket columns into the bucket count, so each task
    writes one bucket; Spark drops that shuffle when the rows already arrive
    partitioned so (e.g. from a join on the bucket key)."""
    if buckets and bucket_by:
        return df.repartition(buckets, *bucket_by)
    if rebalance is None:
        rebalance = bool(partition_by)
    if not rebalance:
        return df
    if partition_by:
        return df.hint("rebalance", *partition_by)
    return df.hint("rebalance")


def scan_base(
    spark: SparkSession,
    target: str,
    fmt: str = DEFAULT_FORMAT,
    schema: StructType | str | None = None,
) -> DataFrame:
    """The managed base table, by catalog name or folder path.

    A folder's partition column types are otherwise inferred from the
    directory names (``0012`` would read as the integer 12, and a rewrite
    would then file it under ``12``); pass the table's ``schema`` to keep
    them.  A catalog table carries its own types.
    """
    if _is_path(target):
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(target)
    return spark.table(target)


def target_columns(spark: SparkSession, target: str, fmt: str = DEFAULT_FORMAT) -> list[str]:
    return scan_base(spark, target, fmt).columns


def folder_partitions(spark: SparkSession, target: str, fmt: str = DEFAULT_FORMAT) -> list[str]:
    """Partition columns of a folder, from its file names (``col=value`` parts)."""
    files = spark.read.format(fmt).load(target).inputFiles()
    root = target.rstrip("/").split("://")[-1].removeprefix("file:")
    below = files[0].split(root, 1)[-1] if files else ""
    return [part.split("=", 1)[0] for part in below.split("/")[:-1] if "=" in part]


def append(
    df: DataFrame,
    target: str,
    fmt: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] | None = None,
    rebalance: bool | None = None,
) -> None:
    """S3: ``INSERT INTO TABLE``: add rows, columns matched by position.

    A new path target is created with ``df``'s columns.  Rows go into a
    partitioned folder by its own layout; another one is refused, since files
    outside the partition folders would be lost to readers.
    """
    spark = df.sparkSession
    exists = _exists(spark, target, fmt)
    if exists:
        df, partition_by = _by_position(df, target, fmt, partition_by)
    out = _prepare(df, partition_by, rebalance)
    if _is_path(target):
        w = out.write.mode("append").format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(target)
    elif exists:
        out.write.insertInto(target)
    else:
        w = out.write.format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.saveAsTable(target)


def _by_position(
    df: DataFrame, target: str, fmt: str, partition_by: Sequence[str] | None
) -> tuple[DataFrame, Sequence[str] | None]:
    """``df`` under the target's column names, and a folder's own partition columns."""
    spark = df.sparkSession
    cols = target_columns(spark, target, fmt)
    if len(cols) != len(df.columns):
        raise ValueError(
            f"append: target has {len(cols)} columns, rows have {len(df.columns)}"
        )
    df = df.toDF(*cols)
    if _is_path(target):
        layout = folder_partitions(spark, target, fmt)
        if partition_by is not None and list(partition_by) != layout:
            raise ValueError(f"append: the folder is partitioned by {layout}, not by {list(partition_by)}")
        partition_by = layout or None
    return df, partition_by


def append_files(
    df: DataFrame,
    target: str,
    mark: str,
    fmt: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] | None = None,
    rebalance: bool | None = None,
) -> str:
    """S3/S4 for a load that may be repeated: add the rows of one load, named
    ``mark``, once.  Returns the folder to delete when the load is noted as over.

    The rows are written to a folder of the load's own inside the target,
    which readers skip (its name begins with ``_``), and a file there tells
    that they are complete.  Then each file is renamed into its place, under a
    name that begins with the mark.  A repeated call writes nothing that is
    complete, moves the files that are still aside and leaves the others, so
    neither a cut at any step nor the rows of another writer change the
    outcome.  Readers see the files as they come, as with a plain append.

    A catalog table's new partitions are added to it last; its partitions
    must lie in the table's own folder.
    """
    spark = df.sparkSession
    named = not _is_path(target)
    if _exists(spark, target, fmt):
        df, partition_by = _by_position(df, target, fmt, partition_by)
    elif named:
        write_table(df.limit(0), target, fmt, partition_by)
    aside = write_aside(df, target, mark, fmt, partition_by, rebalance)
    swaps.move_files(spark, aside, aside.rsplit("/", 1)[0], mark)
    partition_by = table_layout(spark, target)["partition_by"] if named else None
    if named and partition_by:
        _add_partitions(spark, target, aside, partition_by)
    refresh(spark, target)
    return aside


def table_home(spark: SparkSession, target: str) -> str:
    """The folder that holds a table's files."""
    return (target if _is_path(target) else _location(spark, target)).rstrip("/")


def aside_folder(spark: SparkSession, target: str, mark: str) -> str:
    return f"{table_home(spark, target)}/{swaps.ASIDE}{mark}"


def write_aside(
    df: DataFrame,
    target: str,
    mark: str,
    fmt: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] | None = None,
    rebalance: bool | None = None,
) -> str:
    """Write rows whole, in the target's own layout and types, to a folder in
    the target that readers skip, unless the load ``mark`` did so before."""
    spark = df.sparkSession
    layout: dict = {}
    if not _is_path(target):
        layout = table_layout(spark, target)
        if layout["format"] == "hive":
            raise ValueError(f"{target} is not a table of a Spark data source")
        fmt, partition_by = layout["format"], layout["partition_by"] or None
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in spark.table(target).schema])
    aside = aside_folder(spark, target, mark)
    if swaps.is_complete(spark, aside):
        return aside
    if layout.get("buckets"):
        # Only a table can be written in buckets; its files stay when its name goes.
        side = scratch_table_name("aside")
        swaps.delete_folder(spark, aside)
        write_table(df, side, fmt, partition_by, "error", rebalance, aside, layout["buckets"], layout["bucket_by"], layout["sort_by"])
        swaps.drop_table(spark, side)
    else:
        write_table(df, aside, fmt, partition_by, "overwrite", rebalance)
    swaps.mark_complete(spark, aside)
    return aside


def replace_files(
    df: DataFrame, target: str, old_files: Sequence[str], mark: str, fmt: str = DEFAULT_FORMAT, keep: bool = False
) -> str:
    """Put the rows of ``df`` in the place of some files of an unpartitioned
    table or folder; its other files are not touched.

    The rows are written aside whole first, so ``df`` may read the old files.
    Then the new files are moved in and the old ones deleted.  A record of the
    names (``swaps``) is open meanwhile: the next load removes what was
    written if it was not complete, else it ends the moves and deletions.  A
    reader that lists the folder between the first move and the last deletion
    sees old and new rows; ``swap_in`` is the way without that.

    ``keep`` leaves the (emptied) folder ``write_aside`` wrote, which tells a
    repeated load that it was applied; its name is returned.
    """
    spark = df.sparkSession
    aside = aside_folder(spark, target, mark)
    record = swaps.Record(spark, target)
    record.write(kind="files", aside=aside, mark=mark, old=list(old_files), keep=keep)
    write_aside(df, target, mark, fmt)
    swaps.finish_files(spark, record.read())
    record.remove()
    refresh(spark, target)
    return aside


def refresh(spark: SparkSession, target: str) -> None:
    """Forget cached file lists of a target."""
    if _is_path(target):
        spark.catalog.refreshByPath(target)
    else:
        spark.catalog.refreshTable(target)


# Partitions named in one ALTER TABLE statement.
PARTITIONS_PER_STATEMENT = 500


def _add_partitions(spark: SparkSession, target: str, aside: str, partition_by: Sequence[str]) -> None:
    """Add the partitions whose folders were made below ``aside``, if new."""
    fs, path = swaps.filesystem(spark, aside)
    level = [(path(aside), [])]
    for name in partition_by:
        level = [
            (child.getPath(), [*found, unquote(child.getPath().getName().split("=", 1)[1])])
            for folder, found in level
            for child in fs.listStatus(folder)
            if child.isDirectory() and child.getPath().getName().startswith(f"{name}=")
        ]
    specs = [
        ", ".join(f"`{c}` = {'NULL' if v == '__HIVE_DEFAULT_PARTITION__' else _quoted(v)}" for c, v in zip(partition_by, found, strict=True))
        for _, found in level
    ]
    for i in range(0, len(specs), PARTITIONS_PER_STATEMENT):
        parts = " ".join(f"PARTITION ({x})" for x in specs[i : i + PARTITIONS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS {parts}")


def append_partitioned(
    df: DataFrame,
    target: str,
    partition_col: str,
    fmt: str = DEFAULT_FORMAT,
    rebalance: bool | None = None,
) -> None:
    """Dynamic-partition insert; the partition column is moved last."""
    cols = [c for c in df.columns if c != partition_col] + [partition_col]
    append(df.select(*cols), target, fmt, [partition_col], rebalance)


def overwrite_partitions(
    df: DataFrame,
    target: str,
    partition_col: str,
    fmt: str = DEFAULT_FORMAT,
    rebalance: bool | None = None,
    stored: str | None = None,
) -> None:
    """``INSERT OVERWRITE ... PARTITION(p)``: only partitions present in
    ``df`` are replaced; the others are left as they are.

    A folder target is written to a staging folder and the touched partition
    folders are swapped at job commit, so ``df`` may read the target itself.
    Spark refuses that for a catalog table, so there the rebuilt rows are
    first written to the shared scratch folder (a copy of only the rebuilt
    partitions; ``stored`` names the Parquet folder that holds them already)
    and inserted from it by a session of their own: the insert takes its
    overwrite mode from the session, and the caller's stays as it is for
    other loads running in it.
    """
    cols = [c for c in df.columns if c != partition_col] + [partition_col]
    if _is_path(target):
        out = _prepare(df.select(*cols), [partition_col], rebalance)
        w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        w.format(fmt).partitionBy(partition_col).save(target)
        return
    spark = df.sparkSession
    folder = stored or scratch_path(spark, "rebuilt")
    if not stored:
        df.write.parquet(folder)
    own = _session_like(spark)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = own.read.schema(df.schema).parquet(folder).select(*cols)
    _prepare(rows, [partition_col], rebalance).write.mode("overwrite").insertInto(swaps.full_name(spark, target), overwrite=True)
    if not stored:
        swaps.delete_folder(spark, folder)
    spark.catalog.refreshTable(target)


def _session_like(spark: SparkSession) -> SparkSession:
    """A session of the same application with the same settings."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def write_table(
    df: DataFrame,
    target: str,
    fmt: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] | None = None,
    mode: str = "error",
    rebalance: bool | None = None,
    location: str | None = None,
    buckets: int | None = None,
    bucket_by: Sequence[str] | None = None,
    sort_by: Sequence[str] | None = None,
) -> None:
    """Write ``df`` as a new table (catalog name, optionally at ``location``)
    or folder.

    ``buckets`` / ``bucket_by`` (catalog tables only) store the table
    bucketed on its key: later key joins read it without shuffling it, and
    only the other side moves.  Spark keeps the buckets in a join only when
    their count is at least ``spark.sql.shuffle.partitions``.  A key holding a
    large share of the rows sits in one bucket, so bucket on keys known to be
    spread.
    """
    out = _prepare(df, partition_by, rebalance, buckets, bucket_by)
    w = out.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if buckets and bucket_by:
        if _is_path(target):
            raise ValueError("write_table: bucketing needs a catalog table")
        w = w.bucketBy(buckets, *bucket_by)
        if sort_by:
            w = w.sortBy(*sort_by)
    if _is_path(target):
        w.save(target)
    else:
        if location:
            w = w.option("path", location)
        w.saveAsTable(target)


def swap_in(
    new: DataFrame,
    target: str,
    fmt: str | None = None,
    partition_by: Sequence[str] | None = None,
    location: str | None = None,
    rebalance: bool | None = None,
    properties: Mapping[str, str] | None = None,
) -> str:
    """Write ``new`` as a side table, then rename it into the place of
    ``target``.

    ``new`` may read ``target``: it is fully written (and read back once)
    before the old table is touched, so a failure while writing leaves the
    old table as it was.  The swap is two renames and a drop: the old table
    is renamed aside, the new one takes its name, and only then is the old
    one dropped.  A record of the names is written first, so the next load of
    the target undoes or finishes a swap that was cut (``recover``).  The new
    table keeps the old one's format, partitioning,
    bucketing and properties unless given otherwise, and an external table
    stays one: without ``location`` its new version goes to a fresh folder
    beside the old, and the superseded folder is deleted last.
    ``properties`` are set before the swap, so they come with the rows.
    """
    swap = begin_swap(new, target, fmt, partition_by, location, rebalance, properties)
    swap.set_aside()
    swap.put_in_place()
    swap.finish()
    return target


class TableSwap:
    """The steps of ``swap_in`` after the new rows are written; the record of
    ``swaps`` is open until ``finish``."""

    def __init__(self, spark: SparkSession, target: str, names: dict, had_old: bool):
        self.spark, self.target, self.names, self.had_old = spark, target, names, had_old
        self.side, self.old, self.old_location = names["new"], names["old"], names["old_location"]

    def set_aside(self) -> None:
        swaps.Record(self.spark, self.target).write(**{**self.names, "swapping": True})
        if self.had_old:
            swaps.rename_table(self.spark, self.target, self.old)

    def put_in_place(self) -> None:
        swaps.rename_table(self.spark, self.side, self.target)

    def finish(self) -> None:
        swaps.drop_table(self.spark, self.old)
        self.spark.catalog.refreshTable(self.target)
        if self.old_location and not swaps.same_place(self.spark, self.old_location, external_location(self.spark, self.target)):
            swaps.delete_folder(self.spark, self.old_location)
        swaps.Record(self.spark, self.target).remove()


def begin_swap(
    new: DataFrame,
    target: str,
    fmt: str | None = None,
    partition_by: Sequence[str] | None = None,
    location: str | None = None,
    rebalance: bool | None = None,
    properties: Mapping[str, str] | None = None,
) -> TableSwap:
    """First half of ``swap_in``: open the record and write the side table."""
    spark = new.sparkSession
    recover(spark, target)
    had_old = spark.catalog.tableExists(target)
    layout = table_layout(spark, target) if had_old else {}
    fmt = fmt or layout.get("format") or DEFAULT_FORMAT
    partition_by = partition_by if partition_by is not None else layout.get("partition_by") or None
    if partition_by:
        new = new.select(*[c for c in new.columns if c not in partition_by], *partition_by)
    db = f"{target.rsplit('.', 1)[0]}." if "." in target else ""
    short = target.split(".")[-1]
    side, old = db + scratch_table_name(f"{short}_final"), db + scratch_table_name(f"{short}_old")
    old_location = external_location(spark, target) if had_old else None
    if old_location and not location:
        parent, name = old_location.rstrip("/").rsplit("/", 1)
        location = f"{parent}/{name.split('__v-')[0]}__v-{uuid.uuid4().hex[:12]}"
    if location:
        fs, path = swaps.filesystem(spark, location)
        if fs.exists(path(location)) and fs.listStatus(path(location)):
            raise ValueError(f"swap_in: the folder {location} is not empty")
    names = {
        "kind": "table", "new": side, "old": old, "old_location": old_location, "swapping": False,
        "side_location": location or f"{_database_folder(spark, target)}/{side.split('.')[-1]}",
    }
    swaps.Record(spark, target).write(**names)
    write_table(new, side, fmt, partition_by, "error", rebalance, location,
                layout.get("buckets"), layout.get("bucket_by"), layout.get("sort_by"))
    # The new table must be readable before the old one is touched.
    spark.table(side).select(F.lit(1)).limit(1).collect()
    props = {**(table_properties(spark, target) if had_old else {}), **(properties or {})}
    if props:
        listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in props.items())
        spark.sql(f"ALTER TABLE {side} SET TBLPROPERTIES ({listed})")
    return TableSwap(spark, target, names, had_old)


def _database_folder(spark: SparkSession, target: str) -> str:
    db = target.rsplit(".", 1)[0] if "." in target else spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(db).locationUri.rstrip("/")


def _quoted(text: str) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def overwrite(
    df: DataFrame,
    target: str,
    fmt: str | None = None,
    partition_by: Sequence[str] | None = None,
    location: str | None = None,
    rebalance: bool | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """``INSERT OVERWRITE TABLE``: replace all rows.

    A catalog table goes through ``swap_in`` (Spark refuses to overwrite a
    table the same plan reads).  A folder is written whole beside the target
    first and renamed into its place, so a failed write leaves the old rows;
    a cut between the renames is mended by the next load (``recover``).
    """
    if not _is_path(target):
        swap_in(df, target, fmt, partition_by, location, rebalance, properties)
        return
    swap = begin_folder_swap(df, target, fmt, partition_by, rebalance)
    swap.set_aside()
    swap.put_in_place()
    swap.finish()


class FolderSwap:
    """The steps of a folder ``overwrite`` after the new rows are written."""

    def __init__(self, spark: SparkSession, home: str, new: str, old: str):
        self.spark, self.home, self.new, self.old = spark, home, new, old

    def set_aside(self) -> None:
        fs, path = swaps.filesystem(self.spark, self.home)
        if fs.exists(path(self.home)):
            swaps.rename_folder(self.spark, self.home, self.old)

    def put_in_place(self) -> None:
        swaps.rename_folder(self.spark, self.new, self.home)

    def finish(self) -> None:
        swaps.delete_folder(self.spark, self.old)
        swaps.Record(self.spark, self.home).remove()
        self.spark.catalog.refreshByPath(self.home)


def begin_folder_swap(
    df: DataFrame, target: str, fmt: str | None = None, partition_by: Sequence[str] | None = None, rebalance: bool | None = None
) -> FolderSwap:
    """First half of a folder ``overwrite``: open the record and write the rows beside the target."""
    spark, home, mark = df.sparkSession, target.rstrip("/"), uuid.uuid4().hex[:12]
    recover(spark, home)
    new, old = f"{home}__new-{mark}", f"{home}__old-{mark}"
    swaps.Record(spark, home).write(kind="folder", new=new, old=old)
    write_table(df, new, fmt or DEFAULT_FORMAT, partition_by, "error", rebalance)
    return FolderSwap(spark, home, new, old)


def _exists(spark: SparkSession, target: str, fmt: str) -> bool:
    if _is_path(target):
        try:
            spark.read.format(fmt).load(target).schema
            return True
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # missing folder / no files yet
                return False
            raise
    return spark.catalog.tableExists(target)
