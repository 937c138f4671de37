"""Session settings and the shared working folder."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Session-level settings the results or the state size depend on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Sessions of a hot key are merged on the map side before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # State lives off-heap and on local disk instead of in the executor heap; only the
    # changes go to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for checkpoints and written tables, on storage all executors share.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local-mode
    session without that setting gets a temporary folder. ``remove_work_folders`` clears up.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="tidewatch-")
    _made.append(f"{shared.rstrip('/')}/tidewatch/{purpose}-{uuid.uuid4().hex}")
    return _made[-1]


def _storage(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()), at


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, wherever it is."""
    system, at = _storage(spark, path)
    system.delete(at, True)


def written_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly below ``path`` that a finished write left, by name."""
    system, at = _storage(spark, path)
    if not system.exists(at):
        return []
    names = [f.getPath().getName() for f in system.listStatus(at) if f.isDirectory()]
    done = [n for n in names if system.exists(_storage(spark, f"{path}/{n}/_SUCCESS")[1])]
    return [f"{path}/{n}" for n in sorted(done)]


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names directly below a folder, sorted; none if there is no such folder."""
    system, at = _storage(spark, path)
    if not system.exists(at):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(at))


def leaf_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The folders ``depth`` levels of ``name=value`` below a folder, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}".lstrip("/") for f in found for n in names_in(spark, f"{path}/{f}")
                 if "=" in n]
    return found


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """A small text file that appears whole, or not at all if there is one of that name."""
    system, at = _storage(spark, path)
    _, draft = _storage(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    done = not system.exists(at) and system.rename(draft, at)
    if not done:
        system.delete(draft, False)
    return done


def get_text(spark: SparkSession, path: str) -> str:
    system, at = _storage(spark, path)
    stream = system.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


_made: list[str] = []


def remove_work_folders(spark: SparkSession) -> None:
    """Remove what ``work_folder`` has given out in this process, once nobody reads it."""
    while _made:
        remove_folder(spark, _made.pop())


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Shuffle width of the streams started inside.

    Stateful queries cannot adapt their width, and the first start freezes it in the checkpoint.
    It is that of ``spark.sql.shuffle.partitions``, whatever cores happen to be registered, or
    of ``spark.tidewatch.statePartitions`` where that is set.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, spark.conf.get("spark.tidewatch.statePartitions", before))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def throwaway_state(spark: SparkSession) -> Iterator[None]:
    """For streams that run once over a table and drop their checkpoint: one partition a core."""
    name = "spark.tidewatch.statePartitions"
    cores = min(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(cores))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
