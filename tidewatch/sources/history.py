"""Reading the partitioned history back, and keeping it readable.

The job lands each batch below ``run=…/batch=…`` in folders of its own. Which of them count is said
by a manifest (``_manifest`` beside them): a note for each finished batch, and snapshots in which
compaction says what replaced what. Readers go by the manifest, so they see finished batches only,
whole, and never list what has been merged. Folders without a manifest, as ``write_history`` leaves
them, are read as they are.
"""

import datetime as dt
import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import get_text, leaf_folders, names_in, put_text, remove_folder

#: What Spark writes for a partition value that is null.
_NULL = "__HIVE_DEFAULT_PARTITION__"
_BATCH = ("run", "batch")


@dataclass(frozen=True)
class Leaf:
    """A folder of files: ``run=…/batch=…/par=…/fecha=…``, relative to the history."""

    folder: str

    def values(self) -> dict[str, str | None]:
        """Partition values by column."""
        pairs = (part.split("=", 1) for part in self.folder.split("/"))
        return {name: None if value == _NULL else unquote(value) for name, value in pairs}

    def partition(self) -> tuple:
        return tuple((k, v) for k, v in self.values().items() if k not in _BATCH)


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def _note(path: str, run: str, batch: int) -> str:
    return f"{_manifest(path)}/add-{run}-{batch}.json"


def forget_batch(spark: SparkSession, path: str, run: str, batch: int) -> None:
    """Before a batch is written, maybe again: what an earlier attempt left does not count."""
    remove_folder(spark, _note(path, run, batch))


def note_batch(spark: SparkSession, path: str, run: str, batch: int, partitions: int) -> None:
    """Note that a batch is finished: from now on its folders count."""
    below = f"run={run}/batch={batch}"
    leaves = [f"{below}/{f}".rstrip("/")
              for f in leaf_folders(spark, f"{path}/{below}", partitions)]
    put_text(spark, _note(path, run, batch), json.dumps(leaves))


@dataclass
class _Manifest:
    """``notes`` by file name, and the last snapshot: its number, and two lists of folders.

    Those in ``merged`` count no longer though notes may still name them.
    """

    notes: dict[str, list[str]]
    number: int
    closed: list[str]
    merged: list[str]

    def live(self) -> list[Leaf]:
        gone = set(self.merged)
        noted = [f for leaves in self.notes.values() for f in leaves if f not in gone]
        return [Leaf(f) for f in sorted({*noted, *self.closed})]


def _read_manifest(spark: SparkSession, path: str) -> _Manifest | None:
    names = names_in(spark, _manifest(path))
    kept = [n for n in names if n.endswith(".json") and not n.startswith(".")]
    if not kept:
        return None
    snapshots = [n for n in kept if n.startswith("snapshot-")]
    last = json.loads(get_text(spark, f"{_manifest(path)}/{snapshots[-1]}")) if snapshots else {
        "closed": [], "merged": []
    }
    notes = {n: json.loads(get_text(spark, f"{_manifest(path)}/{n}"))
             for n in kept if n.startswith("add-")}
    number = int(snapshots[-1].split("-")[1].split(".")[0]) if snapshots else 0
    return _Manifest(notes, number, last["closed"], last["merged"])


def live_leaves(spark: SparkSession, path: str) -> list[Leaf] | None:
    """The folders that make up a history; None where no manifest tells."""
    found = _read_manifest(spark, path)
    return None if found is None else found.live()


def read_history(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    only: Callable[[dict], bool] | None = None,
) -> DataFrame:
    """A partitioned history; filters on its partition columns skip whole directories.

    The schema is declared, or Spark would read an all-digit ``par`` as a number. ``only`` sees the
    partition values of each folder in the manifest, as text, and says which are worth listing.
    """
    leaves = live_leaves(spark, path)
    reader = spark.read.schema(schema)
    if leaves is None:
        return reader.parquet(path)
    return _read_leaves(spark, path, schema, [f for f in leaves if not only or only(f.values())])


def _read_leaves(spark: SparkSession, path: str, schema: T.StructType, leaves: list[Leaf]
                 ) -> DataFrame:
    if not leaves:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    folders = [f"{path.rstrip('/')}/{leaf.folder}" for leaf in leaves]
    return reader.parquet(*folders).drop(*_BATCH)


def history_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partition_by: tuple[str, ...]
) -> DataFrame:
    """Register a history as an external table, or bring an earlier one up to date.

    The catalog knows each folder that counts, so a query lists only those that its filters on
    partition columns leave. A job's history has the columns ``run`` and ``batch`` besides.
    """
    leaves = live_leaves(spark, path)
    more = [] if leaves is None else [("run", "string"), ("batch", "bigint")]
    typed = [(f.name, f.dataType.simpleString()) for f in schema.fields] + more
    columns = ", ".join(f"`{column}` {kind}" for column, kind in typed)
    keys = ", ".join([c for c, _ in more] + list(partition_by))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        f" PARTITIONED BY ({keys}) LOCATION '{path}'"
    )
    if leaves is None:
        spark.sql(f"MSCK REPAIR TABLE {name}")
        return spark.table(name)
    known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    wanted = {leaf.folder: leaf for leaf in leaves}
    gone = [Leaf(f) for f in known if f not in wanted]
    fresh = [leaf for f, leaf in wanted.items() if f not in known]
    for i in range(0, len(gone), 500):
        specs = ", ".join(f"PARTITION ({_spec(leaf)})" for leaf in gone[i:i + 500])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
    for i in range(0, len(fresh), 500):
        specs = " ".join(
            f"PARTITION ({_spec(leaf)}) LOCATION '{path.rstrip('/')}/{leaf.folder}'"
            for leaf in fresh[i:i + 500]
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(name)
    return spark.table(name).drop(*_BATCH)


def _spec(leaf: Leaf) -> str:
    def literal(value: str | None) -> str:
        if value is None:
            return "null"
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return ", ".join(f"{k}={literal(v)}" for k, v in leaf.values().items())


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    before: dt.date,
    write: Callable[[DataFrame, str], None],
    date: str = "fecha",
) -> int:
    """Merge the folders of each closed partition into one; returns how many were merged.

    Closed are partitions with a ``date`` before ``before``. Rows that come late for one land in a
    new folder, which the next run merges. The newest batch of each run stays as it is: it may run
    again. ``write`` writes a table to a folder, partitioned by ``partition_by``. Merged folders are
    removed by the next run, so that readers who have planned on them can end. Of two
    compactions at once one wins and the other leaves nothing.
    """
    found = _read_manifest(spark, path)
    if found is None:
        return 0
    for folder in found.merged:
        remove_folder(spark, f"{path}/{folder}")
    gone, notes = set(found.merged), {}
    for name, leaves in found.notes.items():
        if leaves and gone.issuperset(leaves):
            remove_folder(spark, f"{_manifest(path)}/{name}")
        else:
            notes[name] = leaves
    now = _Manifest(notes, found.number, found.closed, found.merged)

    newest: dict[str, int] = {}
    for leaf in now.live():
        values = leaf.values()
        newest[values["run"]] = max(newest.get(values["run"], -1), int(values["batch"]))
    closed = set(found.closed)
    parts = defaultdict(list)
    for leaf in now.live():
        values = leaf.values()
        open_batch = leaf.folder not in closed and newest[values["run"]] == int(values["batch"])
        if not open_batch and values.get(date) and values[date] < before.isoformat():
            parts[leaf.partition()].append(leaf)
    merge = [leaf for leaves in parts.values() for leaf in leaves
             if len(leaves) > 1 or leaf.folder not in closed]
    if not merge:
        return 0

    below = f"run=closed-{uuid.uuid4().hex}/batch={now.number + 1}"
    write(_read_leaves(spark, path, schema, merge), f"{path}/{below}")
    made = [f"{below}/{f}" for f in leaf_folders(spark, f"{path}/{below}", len(partition_by))]
    merged = [leaf.folder for leaf in merge]
    noted = {f for leaves in notes.values() for f in leaves}
    snapshot = {
        "closed": sorted((closed - set(merged)) | set(made)),
        # Notes that name folders merged earlier are still there if other folders of theirs count.
        "merged": sorted({*merged, *(gone & noted)}),
    }
    name = f"{_manifest(path)}/snapshot-{now.number + 1:020d}.json"
    if not put_text(spark, name, json.dumps(snapshot)):
        remove_folder(spark, f"{path}/{below}")
        return 0
    return len(merge)
