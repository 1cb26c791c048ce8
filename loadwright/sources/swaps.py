"""Records of table swaps, and what to do about one that was cut.

A swap writes the new rows beside the target, renames the target aside, renames
the new rows into its place and deletes the old ones.  A driver can be lost
between any two of these steps.  So the swap's names are written to a small
record in the shared folder first, and every load begins with ``recover``:

- cut before the new rows took the target's name: the swap is undone.  The old
  rows get their name back and the new ones are deleted, so the load can be
  run again;
- cut after that: the swap is done.  Only the old rows are deleted.

So such a load takes effect at one rename or not at all.  A load that replaces
some files of a table (kind ``files``) takes effect once its new files are
written whole: cut before, they are deleted; cut after, the rest of them is
moved in and the rest of the old ones deleted.  The record lies under the
folder that ``spark.checkpoint.dir`` names (not in an application's own part of
it), so the driver that repeats the load finds it if it has the same setting.
One writer at a time works on a target.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from loadwright.session import checkpoint_root


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system of ``path``, and a function from text to its paths."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    return jpath(path).getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _shared_folder(spark: SparkSession) -> str:
    own = checkpoint_root(spark)
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (named or own.rstrip("/").rsplit("/", 1)[0]).rstrip("/")


def full_name(spark: SparkSession, target: str) -> str:
    """The name a target has for every session."""
    if "/" in target or ":" in target:
        fs, path = filesystem(spark, target)
        return fs.makeQualified(path(target.rstrip("/"))).toString()
    return target if "." in target else f"{spark.catalog.currentDatabase()}.{target}"


class Record:
    """The open swap of one target; a JSON file, replaced as a whole."""

    def __init__(self, spark: SparkSession, target: str):
        mark = hashlib.sha256(full_name(spark, target).encode()).hexdigest()[:32]
        self.spark = spark
        self.file = f"{_shared_folder(spark)}/loadwright-swaps/{mark}.json"
        self.fs, self.path = filesystem(spark, self.file)

    def write(self, **names) -> None:
        part = self.path(self.file + ".part")
        out = self.fs.create(part, True)
        out.write(json.dumps(names).encode())
        out.close()
        self.fs.delete(self.path(self.file), False)
        if not self.fs.rename(part, self.path(self.file)):
            raise OSError(f"could not write {self.file}")

    def read(self) -> dict | None:
        # A record is replaced by delete and rename, always with the same
        # names, so between the two its ``.part`` holds it whole.
        for name in (self.file, self.file + ".part"):
            if self.fs.exists(self.path(name)):
                stream = self.fs.open(self.path(name))
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                stream.close()
                try:
                    return json.loads(text)
                except ValueError:
                    continue  # cut while it was first written: nothing was swapped yet
        return None

    def remove(self) -> None:
        for name in (self.file, self.file + ".part"):
            self.fs.delete(self.path(name), False)


# Folders inside a table that hold a load's files before they are moved in;
# readers skip names that begin with an underscore.
ASIDE = "_loadwright-"


def is_complete(spark: SparkSession, aside: str) -> bool:
    fs, path = filesystem(spark, aside)
    return fs.exists(path(f"{aside}/_complete"))


def mark_complete(spark: SparkSession, aside: str) -> None:
    fs, path = filesystem(spark, aside)
    fs.create(path(f"{aside}/_complete"), True).close()


def move_files(spark: SparkSession, aside: str, home: str, mark: str) -> None:
    """Rename the data files below ``aside`` to the same places below ``home``,
    under names that begin with ``mark``."""
    fs, path = filesystem(spark, home)
    root = fs.makeQualified(path(aside)).toString()
    listed = fs.listFiles(path(aside), True)
    files = []
    while listed.hasNext():
        file = listed.next().getPath()
        if not file.getName().startswith(("_", ".")):
            files.append(file)
    for file in files:
        below = file.getParent().toString().removeprefix(root).strip("/")
        place = path(f"{home}/{below}" if below else home)
        fs.mkdirs(place)
        move_file(fs, file, path(place, f"{mark}-{file.getName()}"))


def move_file(fs, file, place) -> None:
    if not fs.rename(file, place):
        raise OSError(f"could not move {file.toString()} to {place.toString()}")


def finish_files(spark: SparkSession, names: dict) -> None:
    """Move the new files in, then delete the ones they replace."""
    aside = names["aside"]
    move_files(spark, aside, aside.rsplit("/", 1)[0], names["mark"])
    for file in names["old"]:
        delete_file(spark, file)
    if not names["keep"]:
        delete_folder(spark, aside)


def delete_file(spark: SparkSession, file: str) -> None:
    fs, path = filesystem(spark, file)
    fs.delete(path(file), False)


def rename_folder(spark: SparkSession, src: str, dst: str) -> None:
    fs, path = filesystem(spark, src)
    if not fs.rename(path(src), path(dst)):
        raise OSError(f"could not rename {src} to {dst}")


def delete_folder(spark: SparkSession, folder: str | None) -> None:
    if folder:
        fs, path = filesystem(spark, folder)
        fs.delete(path(folder), True)


def rename_table(spark: SparkSession, name: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {new}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def same_place(spark: SparkSession, a: str, b: str | None) -> bool:
    """Is one folder the other, or above or below it (or ``b`` unknown)?"""
    if not b:
        return True
    fs, path = filesystem(spark, a)
    x, y = (fs.makeQualified(path(p)).toString().rstrip("/") + "/" for p in (a, b))
    return x.startswith(y) or y.startswith(x)


def recover(spark: SparkSession, target: str, location_of: Callable[[SparkSession, str], str | None]) -> str | None:
    """Finish or undo a cut swap of ``target``: ``"undone"``, ``"done"`` or None.

    ``location_of`` gives the folder of a catalog table.
    """
    record = Record(spark, target)
    names = record.read()
    if names is None:
        record.remove()
        return None
    if names["kind"] == "files":
        outcome = _recover_files(spark, target, names)
    elif names["kind"] == "folder":
        outcome = _recover_folder(spark, target.rstrip("/"), names)
    else:
        outcome = _recover_table(spark, target, names, location_of)
    record.remove()
    return outcome


def _recover_files(spark: SparkSession, target: str, names: dict) -> str:
    if is_complete(spark, names["aside"]):
        finish_files(spark, names)
        outcome = "done"
    else:
        delete_folder(spark, names["aside"])
        outcome = "undone"
    if "/" in target or ":" in target:
        spark.catalog.refreshByPath(target)
    else:
        spark.catalog.refreshTable(target)
    return outcome


def _recover_folder(spark: SparkSession, home: str, names: dict) -> str:
    fs, path = filesystem(spark, home)

    def there(folder: str) -> bool:
        return fs.exists(path(folder))

    if there(names["old"]) and not there(home):
        rename_folder(spark, names["old"], home)
    if there(names["new"]):
        delete_folder(spark, names["new"])
        outcome = "undone"
    else:
        outcome = "done" if there(names["old"]) else "undone"
    delete_folder(spark, names["old"])
    spark.catalog.refreshByPath(home)
    return outcome


def _recover_table(spark: SparkSession, target: str, names: dict, location_of) -> str:
    side, old = names["new"], names["old"]
    there = spark.catalog.tableExists
    if there(old) and not there(target):
        rename_table(spark, old, target)
    # A complete side table goes away only by taking the target's name.
    outcome = "done" if names["swapping"] and not there(side) else "undone"
    drop_table(spark, side)
    drop_table(spark, old)
    # Files of a version that is no longer used, or of a side whose write was
    # cut before the catalog knew it; never those of the table as it is now.
    now = location_of(spark, target) if there(target) else None
    folder = names["old_location"] if outcome == "done" else names["side_location"]
    if folder and (now is None or not same_place(spark, folder, now)):
        delete_folder(spark, folder)
    if there(target):
        spark.catalog.refreshTable(target)
    return outcome
