"""Choose a load pattern by name and run it.

``apply_load`` builds the new table content as one lazy DataFrame;
``run_load`` also writes it with the sink the pattern needs.
"""

from __future__ import annotations

import itertools
import os
import re
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwright.functions.columns import map_columns
from loadwright.operators.filters import predicate
from loadwright.operators.joins import affected_partitions, matching, touched_values
from loadwright.operators.skew import resolve
from loadwright.plans import loads as L
from loadwright.session import checkpointed, scratch_path
from loadwright.sources import swaps
from loadwright.sources import tables as S


def _history(base, stage, spec):
    return L.history_load(stage, spec.get("types"), spec.get("partition"))


def _full_refresh(base, stage, spec):
    return L.full_refresh(stage, spec["exprs"])


def _append_distinct(base, stage, spec):
    return L.append_distinct(base, stage, spec.get("exprs"), spec.get("base_distinct", False))


def _insert_select(base, stage, spec):
    return L.insert_select(base, stage, spec["cols"])


def _upsert(base, stage, spec):
    skew = spec.get("skew", "auto")
    if spec.get("partition"):
        return L.upsert_partitioned(
            base, stage, spec["keys"], spec["partition"], spec.get("order_by"),
            spec.get("exprs"), spec.get("scope", "partition"), skew, spec.get("sets"), spec.get("columns"),
        )
    if spec.get("sets"):
        return L.upsert_accumulate(
            base, stage, spec["keys"], spec["sets"], spec.get("order_by"), spec.get("exprs"), skew
        )
    if spec.get("columns"):
        return L.upsert_partial(
            base, stage, spec["keys"], spec["columns"], spec.get("order_by"), spec.get("exprs"), skew
        )
    return L.upsert(base, stage, spec["keys"], spec.get("order_by"), spec.get("exprs"), spec.get("stage_keys"), skew,
                    spec.get("not_in"))


def _mapped_stage(stage, spec):
    """P5 for update and delete: as many expressions as columns, or none."""
    if stage is None or not spec.get("exprs"):
        return stage
    return map_columns(stage, spec["columns"], spec["exprs"], equal_counts=True)


def _update(base, stage, spec):
    stage = _mapped_stage(stage, spec)
    if stage is not None and spec.get("on"):
        return L.update_from(base, stage, spec["on"], spec["sets"], spec.get("skew", "auto"))
    return L.update_where(base, spec["where"], spec["sets"])


def _delete(base, stage, spec):
    stage = _mapped_stage(stage, spec)
    if stage is not None and spec.get("on"):
        return L.delete_from(base, stage, spec["on"], spec.get("skew", "auto"))
    return L.delete_where(base, spec["where"])


PATTERNS: dict[str, Callable[[DataFrame | None, DataFrame | None, Mapping], DataFrame]] = {
    "history": _history,
    "overwrite": _full_refresh,
    "full_refresh": _full_refresh,
    "distinct": _append_distinct,
    "append_distinct": _append_distinct,
    "insert": _insert_select,
    "insert_select": _insert_select,
    "upsert": _upsert,
    "summarize": _upsert,
    "update": _update,
    "delete": _delete,
}

_UPSERT_KEYS = {"keys", "order_by", "exprs", "partition", "scope", "sets", "columns", "stage_keys", "not_in"}
# What each pattern reads from its spec; any other key is refused.
SPEC_KEYS: dict[str, set[str]] = {
    "history": {"types", "partition"},
    "overwrite": {"exprs", "partition"},
    "full_refresh": {"exprs", "partition"},
    "distinct": {"exprs", "base_distinct", "partition"},
    "append_distinct": {"exprs", "base_distinct", "partition"},
    "insert": {"cols", "partition"},
    "insert_select": {"cols", "partition"},
    "upsert": _UPSERT_KEYS,
    "summarize": _UPSERT_KEYS,
    "update": {"on", "where", "sets", "partition", "columns", "exprs"},
    "delete": {"on", "where", "partition", "columns", "exprs"},
}
for _p in ("upsert", "summarize", "update", "delete"):
    SPEC_KEYS[_p] = SPEC_KEYS[_p] | {"rewrite"}
_ANY_PATTERN = {"pattern", "format", "location", "schema", "skew"}
# Keys of which a pattern can follow only one.
_EXCLUSIVE = [("sets", "columns"), ("partition", "stage_keys"), ("sets", "stage_keys"), ("columns", "stage_keys"),
              ("rewrite", "partition"), ("rewrite", "location"),
              *[("not_in", k) for k in ("sets", "columns", "partition", "stage_keys")]]


def _check_spec(spec: Mapping) -> None:
    pattern = spec.get("pattern")
    given = {k for k, v in spec.items() if v is not None}
    unused = given - SPEC_KEYS[pattern] - _ANY_PATTERN
    if unused:
        raise ValueError(f"load pattern {pattern!r} does not use {sorted(unused)}")
    if spec.get("rewrite") not in (None, "files"):
        raise ValueError(f"rewrite is 'files' or absent, not {spec['rewrite']!r}")
    if pattern in ("upsert", "summarize") or "rewrite" in given:
        for a, b in _EXCLUSIVE:
            if {a, b} <= given and (pattern in ("upsert", "summarize") or "rewrite" in (a, b)):
                raise ValueError(f"load pattern {pattern!r} takes {a!r} or {b!r}, not both")
    if pattern in ("update", "delete") and ("exprs" in given) != ("columns" in given):
        raise ValueError(f"load pattern {pattern!r} takes 'columns' and 'exprs' together")
    if pattern in ("update", "delete") and {"on", "where"} <= given:
        raise ValueError(f"load pattern {pattern!r} takes 'on' or 'where', not both")


# Patterns whose result replaces the whole table without reading it.
_DISCARDS_BASE = {"history", "overwrite", "full_refresh"}


def apply_load(base: DataFrame | None, stage: DataFrame | None, spec: Mapping) -> DataFrame:
    """The table content after the load described by ``spec``.

    ``spec["pattern"]`` is one of ``PATTERNS``; the other keys are the
    pattern's arguments: ``keys``, ``order_by``, ``exprs``, ``columns``,
    ``sets`` (accumulating upsert, ``summarize``), ``partition`` and
    ``scope``, ``where``, ``on``, ``types``, ``cols``, ``skew``, ``base_distinct``,
    ``not_in`` (an upsert's null-aware test); an update or delete from a stage
    maps it by ``columns`` and ``exprs`` of equal counts; ``run_load`` also
    reads ``format``, ``location`` and ``schema`` (a folder target's schema).
    """
    pattern = spec.get("pattern")
    if pattern not in PATTERNS:
        raise ValueError(f"unknown load pattern {pattern!r}; one of {sorted(PATTERNS)}")
    _check_spec(spec)
    if pattern == "summarize" and not spec.get("sets"):
        raise ValueError("summarize needs 'sets'")
    return PATTERNS[pattern](base, stage, spec)


@dataclass(frozen=True)
class Batch:
    """One batch of a stream of loads, applied once even if it is replayed
    after a driver was lost at any point of the load.

    - A table that is swapped in carries the batch number as a property, set
      before the swap.
    - Rebuilt partitions are written to ``folder`` first; a replay overwrites
      the partitions with those rows again instead of rebuilding them.
    - Appended rows are written aside whole and their files moved into the
      target under the batch's name; a replay moves those that are left
      (``tables.append_files``), whatever else was written to the target.
    """

    stream: str
    number: int
    folder: str

    @property
    def property_key(self) -> str:
        return f"loadwright.batch.{self.stream}"

    def in_table(self, spark: SparkSession, target: str) -> bool:
        """Is the batch part of the catalog table as it is now?"""
        if S._is_path(target) or not spark.catalog.tableExists(target):
            return False
        return int(S.table_properties(spark, target).get(self.property_key, -1)) >= self.number

    def _path(self, what: str) -> str:
        return os.path.join(self.folder, f"{what}-{self.number}")

    def note(self, spark: SparkSession, what: str, value: int = 0) -> None:
        spark.createDataFrame([(value,)], "value long").write.mode("overwrite").parquet(self._path(what))

    def noted(self, spark: SparkSession, what: str) -> int | None:
        try:
            found = spark.read.schema("value long").parquet(self._path(what)).head()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return None if found is None else found[0]  # a write cut short leaves no row

    @property
    def rebuilt_folder(self) -> str:
        return self._path("rebuilt")

    def rebuilt(self, spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
        rows = self.rebuilt_folder
        if self.noted(spark, "rebuilt-done") is None:
            build().write.mode("overwrite").parquet(rows)
            self.note(spark, "rebuilt-done")
        return spark.read.parquet(rows)

    def applied(self, spark: SparkSession) -> None:
        """Note that the load is over, and drop the rebuilt rows kept for a replay."""
        self.note(spark, "applied")
        swaps.delete_folder(spark, self.rebuilt_folder)

    @property
    def mark(self) -> str:
        """Begins the names of the files the batch adds."""
        return f"batch-{self.stream}-{self.number}"

    def append(self, rows: DataFrame, target: str, fmt: str, partition_by: list[str] | None) -> None:
        spark = rows.sparkSession
        if self.noted(spark, "appended") is None:
            aside = S.append_files(rows, target, self.mark, fmt, partition_by)
            self.note(spark, "appended")
            swaps.delete_folder(spark, aside)


def _hit_rows(base: DataFrame, stage: DataFrame | None, spec: Mapping) -> DataFrame:
    """Base rows an update / delete touches.

    A filter keeps only rows where the predicate is true, so the bare
    predicate is used: wrapped in ``coalesce(.., false)`` it would reach the
    scan neither as a partition filter nor as a pushed filter.
    """
    if stage is not None and spec.get("on"):
        stage = _mapped_stage(stage, spec)
        return matching(base, stage, spec["on"], "left_semi", spec.get("skew", "auto"))
    return base.where(predicate(spec["where"]))


def _partition_scoped(target: str, base: DataFrame, stage: DataFrame | None, spec: Mapping,
                      part: str, path_fmt: str, batch: Batch | None = None) -> None:
    """Update / delete on a partitioned table: only partitions holding a
    touched row are rebuilt and overwritten; a partition a delete empties is
    dropped (dynamic overwrite leaves partitions absent from its output)."""
    spark = base.sparkSession
    if stage is not None and spec.get("on"):
        # One sample of the base's keys serves the touched partitions and the rebuild.
        spec = {**spec, "skew": resolve(spec.get("skew", "auto"), base, list(spec["on"]))}
    if batch and spec["pattern"] == "update":

        def build() -> DataFrame:
            return apply_load(affected_partitions(base, _hit_rows(base, stage, spec), part), stage, spec)

        S.overwrite_partitions(batch.rebuilt(spark, build), target, part, path_fmt, stored=batch.rebuilt_folder)
        return
    vals, n = touched_values(_hit_rows(base, stage, spec), part)
    rebuilt = apply_load(affected_partitions(base, vals.withColumnRenamed("__k0", part), part), stage, spec)
    emptied = stored = None
    if spec["pattern"] == "delete":
        # Read twice (which partitions are left, then the rows): computed once.
        stored = scratch_path(spark, "rebuilt")
        rebuilt.write.parquet(stored)
        rebuilt = spark.read.schema(rebuilt.schema).parquet(stored)
        left = rebuilt.select(F.col(part).alias("__k0")).distinct()
        emptied = checkpointed(vals.join(left, vals["__k0"].eqNullSafe(left["__k0"]), "left_anti"))
        if S._is_path(target) and (some := emptied.head(5)):
            raise ValueError(f"run_load: the delete empties partitions {[r[0] for r in some]} of a folder target")
    S.overwrite_partitions(rebuilt, target, part, path_fmt, stored=stored)
    swaps.delete_folder(spark, stored)
    if emptied is not None and not S._is_path(target):
        left_over = emptied.toLocalIterator()
        while some := list(itertools.islice(left_over, DROPS_PER_STATEMENT)):
            parts = ", ".join(f"PARTITION ({part} = {'NULL' if v is None else repr(str(v))})" for (v,) in some)
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {parts}")
        spark.catalog.refreshTable(target)


# Emptied partitions reach the driver so many at a time.
DROPS_PER_STATEMENT = 500


# Beyond so many touched files the whole table is rewritten (one swap instead
# of very many single renames).
MAX_TOUCHED_FILES = 10_000


def touched_files(scan: DataFrame, stage: DataFrame | None, spec: Mapping) -> DataFrame:
    """Paths (``file``) of the files of ``scan`` holding a row the load changes
    or drops: all rows an update or delete hits, or whose key an upsert stages."""
    columns = scan.columns
    placed = scan.select("*", F.col("_metadata.file_path").alias("__file"))
    if spec["pattern"] in ("upsert", "summarize"):
        stage_keys = spec.get("stage_keys") or spec["keys"]
        if spec.get("exprs"):
            listed = list(dict.fromkeys([*spec["keys"], *spec["columns"]])) if spec.get("columns") else columns
            stage, stage_keys = map_columns(stage, listed, spec["exprs"]), spec["keys"]
        hit = matching(placed, stage, dict(zip(spec["keys"], stage_keys, strict=True)), "left_semi", spec.get("skew", "auto"))
    else:
        hit = _hit_rows(placed, stage, spec)
    return hit.select(F.col("__file").alias("file")).distinct()


def _rewrite_files(target: str, stage: DataFrame | None, spec: Mapping, fmt: str, batch: Batch | None) -> None:
    """Upsert, update or delete that rewrites only the files it touches.

    Every base row that the load changes or drops lies in a touched file, and
    so does every base row of a staged key; so the load applied to the rows of
    those files alone, beside the other files as they are, is the load applied
    to the table.
    """
    spark = stage.sparkSession if stage is not None else SparkSession.active()
    named = not S._is_path(target)
    layout = S.table_layout(spark, target) if named else {"format": fmt, "partition_by": S.folder_partitions(spark, target, fmt)}
    if layout["partition_by"] or layout["format"] not in ("orc", "parquet"):
        raise ValueError("rewrite='files' needs an unpartitioned ORC or Parquet target")
    fmt = layout["format"]
    mark = batch.mark if batch else f"load-{uuid.uuid4().hex[:12]}"
    aside = S.aside_folder(spark, target, mark)
    if batch and batch.noted(spark, "rewritten") is not None:
        return
    if not (batch and swaps.is_complete(spark, aside)):
        scan = S.scan_base(spark, target, fmt, spec.get("schema"))
        files = checkpointed(touched_files(scan, stage, spec))
        if files.count() > MAX_TOUCHED_FILES and (named or not batch):
            S.overwrite(apply_load(scan, stage, spec), target, None if named else fmt,
                        properties={batch.property_key: str(batch.number)} if batch else None)
            return
        old = sorted(unquote(r[0]) for r in files.collect())  # the column holds URIs
        # Paths are read as patterns; the names are meant literally.
        literal = [re.sub(r"([\\\[\]{}*?])", r"\\\1", f) for f in old]
        held = spark.read.format(fmt).schema(scan.schema).load(literal) if old else spark.createDataFrame([], scan.schema)
        S.replace_files(apply_load(held, stage, spec), target, old, mark, fmt, keep=batch is not None)
    if batch:
        batch.note(spark, "rewritten")
        swaps.delete_folder(spark, aside)


def run_load(target: str, stage: DataFrame | None, spec: Mapping, base: DataFrame | None = None,
             batch: Batch | None = None) -> DataFrame:
    """Apply the load to ``target`` (table name or folder) and write it.

    A swap of the target that was cut is undone or finished first
    (``tables.recover``).  An upsert, update or delete on a table with one
    partition column rewrites only the partitions it touches; an upsert whose
    spec names no ``partition`` finds it in the catalog and keeps every key
    unique (``scope`` "table", unless the spec gives one), as it would without
    partitions.  An
    append-distinct into a distinct base (``base_distinct``) and an
    insert-select append only the new rows; every
    other pattern replaces the table (through ``swap_in`` for a catalog
    table, since the new content reads the old), keeping the table's format,
    partitioning and bucketing.  Returns the table as it is then.

    With ``rewrite="files"`` an upsert, update or delete of an unpartitioned
    ORC or Parquet table or folder rewrites only the files that hold a row it
    changes, found by one scan of the key (or tested) columns; staged rows of
    new keys come in files of their own (``tables.replace_files``).

    ``batch`` names the load within a stream: a batch that is already part of
    the target is not applied again.
    """
    _run_load(target, stage, spec, base, batch)
    src = stage if stage is not None else base
    spark = src.sparkSession if src is not None else SparkSession.active()
    if not S._is_path(target):
        spark.catalog.refreshTable(target)
    return S.scan_base(spark, target, spec.get("format") or S.DEFAULT_FORMAT, spec.get("schema"))


def _table_partition(spark: SparkSession, target: str, spec: Mapping) -> str | None:
    """The partition column an upsert can follow: the only one of a catalog
    table, known for every staged row."""
    if S._is_path(target) or spec.get("stage_keys") or spec.get("not_in") or not spark.catalog.tableExists(target):
        return None
    found = S.table_layout(spark, target)["partition_by"]
    if len(found) != 1 or (spec.get("columns") and found[0] not in [*spec["keys"], *spec["columns"]]):
        return None
    return found[0]


def _run_load(target: str, stage: DataFrame | None, spec: Mapping, base: DataFrame | None, batch: Batch | None) -> None:
    src = stage if stage is not None else base
    spark = src.sparkSession if src is not None else SparkSession.active()
    pattern = spec["pattern"]
    fmt = spec.get("format")  # None: a catalog table keeps its own
    path_fmt = fmt or S.DEFAULT_FORMAT
    S.recover(spark, target)
    if spec.get("rewrite"):
        if base is not None:
            raise ValueError("rewrite='files' reads its target itself, not a given base")
        _check_spec(spec)
        if not (batch and batch.in_table(spark, target)):
            _rewrite_files(target, stage, spec, path_fmt, batch)
        return
    if base is None and pattern not in _DISCARDS_BASE:
        base = S.scan_base(spark, target, path_fmt, spec.get("schema"))
    if pattern not in PATTERNS:
        raise ValueError(f"unknown load pattern {pattern!r}; one of {sorted(PATTERNS)}")
    _check_spec(spec)
    if batch and batch.in_table(spark, target):
        return
    part = spec.get("partition")
    if pattern in ("upsert", "summarize") and not part and (found := _table_partition(spark, target, spec)):
        spec = {"scope": "table", **spec, "partition": found}
        part = found
    if pattern in ("update", "delete"):
        layout_part = part or (S.table_layout(spark, target)["partition_by"] if not S._is_path(target) else [])
        if isinstance(layout_part, str):
            layout_part = [layout_part]
        if len(layout_part or []) == 1:
            _partition_scoped(target, base, stage, spec, layout_part[0], path_fmt, batch)
            return
    if pattern in ("insert", "insert_select"):
        add = batch.append if batch else S.append
        add(L.selected_rows(base, stage, spec["cols"]), target, path_fmt, [part] if part else None)
    elif pattern in ("distinct", "append_distinct") and spec.get("base_distinct"):
        # only the rows not yet in the (distinct) base are written
        new_only = L.distinct_new_rows(base, stage, spec.get("exprs"))
        S.append(new_only, target, path_fmt, [part] if part else None)
    elif pattern in ("upsert", "summarize") and part:
        def build() -> DataFrame:
            return apply_load(base, stage, spec)

        if batch:
            S.overwrite_partitions(batch.rebuilt(spark, build), target, part, path_fmt, stored=batch.rebuilt_folder)
        else:
            S.overwrite_partitions(build(), target, part, path_fmt)
    elif S._is_path(target) and pattern not in _DISCARDS_BASE:
        raise ValueError(
            "run_load: a folder target cannot be rewritten by a plan that reads it; "
            "use a catalog table (swapped in) or a partitioned upsert"
        )
    else:
        S.overwrite(apply_load(base, stage, spec), target, fmt, [part] if part and pattern == "history" else None,
                    spec.get("location"), properties={batch.property_key: str(batch.number)} if batch else None)
