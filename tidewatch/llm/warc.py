"""Web archives (WARC 1.1) as a Spark data source, and pages archived without repeated payloads.

Planning lists the files and puts small ones together; a file is read by one task, as records have
no marks to find them from the middle of a file. A task goes from record to record, headers first.
Predicates on header columns that Spark pushes down are tested there. The payload of a record that
fails, or that no column asks for, is never decoded: plain files are sought past it, compressed
ones (a gzip member for each record) by the lengths that the writer leaves in the member's header
(subfield ``sl``), files of others without those by inflating piece by piece into nothing.

Files are reached through pyarrow's file systems: local and mounted paths, hdfs, s3 and gs. Writing
is atomic: each task writes files under names of its own, and only those that the manifest of a
finished write names are read. Folders without a manifest are read whole.
"""

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    Not,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from .common import cut

# --- fixed values: names and terms of the WARC 1.1 format ---------------------
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "content_type": "content-type",
    "refers_to": "warc-refers-to",
}

#: All columns; a reader makes those it is asked for. ``payload_bytes`` is the length of the whole
#: payload, which a revisit's HTTP headers state too; ``intact`` compares the payload's digest.
SCHEMA = T.StructType([
    *[T.StructField(name, T.StringType()) for name in HEADERS],
    T.StructField("payload_digest", T.StringType()),
    T.StructField("content_length", T.LongType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("intact", T.BooleanType()),
])

#: What ``records`` are written from.
RECORDS = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("target_uri", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("refers_to", T.StringType()),
    T.StructField("sha1", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload", T.BinaryType()),
])

_PIECE = 1 << 18
_LONGEST_HEAD = 1 << 24
_BATCH_ROWS, _BATCH_BYTES = 4096, 8 << 20
_END = b"\r\n\r\n"


def storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path within it."""
    return fs.FileSystem.from_uri(path)


# --- reading one file --------------------------------------------------------


def skip_lengths(member: bytes) -> tuple[int, int] | None:
    """Compressed and inflated length of the gzip member that begins here, where it says so."""
    if len(member) < 24 or member[:3] != b"\x1f\x8b\x08" or not member[3] & 4:
        return None
    if member[10:16] != b"\x0c\x00sl\x08\x00":
        return None
    return struct.unpack("<II", member[16:24])


class Stream:
    """The bytes of a file from front to back, inflated if it is compressed, a piece at a time."""

    def __init__(self, file):
        self.file, self.ready = file, bytearray()
        file.seek(0)
        self.packed = file.read(2) == b"\x1f\x8b"
        file.seek(0)
        self._new_member()

    def _new_member(self) -> None:
        self.inflater, self.raw, self.lengths = None, b"", None

    def _more(self) -> bool:
        """Another piece, unless the file is over."""
        if not self.packed:
            piece = self.file.read(_PIECE)
            self.ready += piece
            return bool(piece)
        while True:
            if self.inflater is None or self.inflater.eof:
                self.raw = self.inflater.unused_data if self.inflater else b""
                while len(self.raw) < 24 and (piece := self.file.read(_PIECE)):
                    self.raw += piece
                if not self.raw:
                    return False
                self.start, self.made = self.file.tell() - len(self.raw), 0
                self.lengths = skip_lengths(self.raw)
                self.inflater = zlib.decompressobj(31)
            elif not self.raw:
                self.raw = self.file.read(_PIECE)
                if not self.raw:
                    raise ValueError("the file ends within a compressed record")
            piece = self.inflater.decompress(self.raw, _PIECE)
            self.raw = self.inflater.unconsumed_tail
            self.made += len(piece)
            if piece:
                self.ready += piece
                return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the mark, which is passed too; None at the end of the file."""
        seen = 0
        while (at := self.ready.find(mark, seen)) < 0:
            seen = max(len(self.ready) - len(mark) + 1, 0)
            if len(self.ready) > _LONGEST_HEAD:
                raise ValueError("no end of the headers")
            if not self._more():
                if self.ready.strip(b"\r\n"):
                    raise ValueError("the file ends within headers")
                return None
        found = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return found

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise ValueError("the file ends within a record")
        found = bytes(self.ready[:n])
        del self.ready[:n]
        return found

    def skip(self, n: int) -> None:
        """Pass n bytes, undecoded where the file allows it."""
        if len(self.ready) < n and not self.packed:
            self.file.seek(n - len(self.ready), 1)
            n = len(self.ready)
        elif self.packed and self.lengths and self.made - len(self.ready) + n == self.lengths[1]:
            # The member ends where the skipped part does.
            self.file.seek(self.start + self.lengths[0])
            self._new_member()
            n = len(self.ready)
        while len(self.ready) < n:
            n -= len(self.ready)
            self.ready.clear()
            if not self._more():
                raise ValueError("the file ends within a record")
        del self.ready[:n]


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; of repeated ones the last. Continued lines are joined."""
    lines = head.decode("utf-8", "replace").replace("\r\n ", " ").replace("\r\n\t", " ")
    pairs = (line.partition(":") for line in lines.split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def records(
    stream: Stream, columns: list[str], wanted: Callable[[dict], bool] = lambda row: True
) -> Iterator[dict]:
    """The records as rows of these columns; ``wanted`` sees the columns that headers tell."""
    while (head := stream.until(_END)) is not None:
        head = head.lstrip(b"\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        found = fields(head)
        length = int(found["content-length"])
        row = {name: found.get(header) for name, header in HEADERS.items()}
        stated = found.get("warc-payload-digest", "")
        row["payload_digest"] = stated.removeprefix("sha1:") or None
        row["content_length"] = length
        row["payload_bytes"] = row["payload"] = row["intact"] = None
        if not wanted(row):
            stream.skip(length + len(_END))
            continue
        left, revisit = length, row["record_type"] == "revisit"
        if (row["content_type"] or "").startswith("application/http") and (
            {"payload_bytes", "payload", "intact"} & set(columns)
        ):
            http = stream.until(_END)
            left -= len(http) + len(_END)
            stated_length = fields(http).get("content-length", "")
            row["payload_bytes"] = int(stated_length) if stated_length.isdigit() else (
                None if revisit else left
            )
        elif not revisit:
            row["payload_bytes"] = length
        if not revisit and {"payload", "intact"} & set(columns):
            payload = stream.take(left)
            left, row["payload"] = 0, payload
            if stated.startswith("sha1:"):
                row["intact"] = digest(hashlib.sha1(payload).hexdigest()) == row["payload_digest"]
        stream.skip(left + len(_END))
        yield {name: row[name] for name in columns}


def digest(sha1: str) -> str:
    """A hexadecimal SHA-1 in base 32, as archives state it."""
    return base64.b32encode(bytes.fromhex(sha1)).decode()


# --- writing one record ------------------------------------------------------


def _value(text: str) -> str:
    """Header values hold no line breaks; those of a URL are percent-encoded."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> bytes:
    """One record of RECORDS, uncompressed. A revisit keeps the HTTP headers and no payload."""
    if row["record_type"] not in ("response", "revisit"):
        raise ValueError(f"cannot write records of type {row['record_type']}")
    http = f"HTTP/1.1 200 OK\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = http + (row["payload"] or b"")
    lines = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": row["record_id"],
        "WARC-Date": row["date"],
        "WARC-Target-URI": row["target_uri"],
        "WARC-Payload-Digest": f"sha1:{digest(row['sha1'])}",
        "WARC-Refers-To": row["refers_to"],
        "WARC-Profile": REVISIT if row["record_type"] == "revisit" else None,
        "Content-Type": HTTP,
        "Content-Length": str(len(block)),
    }
    head = [VERSION, *[f"{k}: {_value(v)}" for k, v in lines.items() if v is not None]]
    return "\r\n".join(head).encode() + _END + block + _END


def member(body: bytes, level: int = 6) -> bytes:
    """A gzip member that states its own lengths, unless they need more than 32 bits."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = packer.compress(body) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(body), len(body) & 0xFFFFFFFF)
    whole = 24 + len(packed) + len(tail)
    if max(whole, len(body)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + packed + tail
    extra = b"\x0c\x00sl\x08\x00" + struct.pack("<II", whole, len(body))
    return b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + extra + packed + tail


# --- the data source ---------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


class Archive(DataSource):
    """``warc``: reads SCHEMA, or the part of it that a declared schema asks for; writes RECORDS.

    Options: ``partition_bytes`` (files read by one task), ``file_bytes`` (a task goes on to
    another file beyond).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> "ArchiveReader":
        return ArchiveReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> "ArchiveWriter":
        return ArchiveWriter(self.options, overwrite)


class ArchiveReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        unknown = set(schema.names) - set(SCHEMA.names)
        if unknown:
            raise ValueError(f"no such columns: {sorted(unknown)}")
        self.path, self.schema = options["path"], schema
        self.partition_bytes = int(options.get("partition_bytes", 128 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        """Keep what headers can tell; Spark tests the others."""
        for f in filters:
            test = _test(f)
            if test:
                self.tests.append(test)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, path = storage(self.path)
        selector = fs.FileSelector(path, recursive=True)
        infos = [i for i in system.get_file_info(selector) if i.type == fs.FileType.File]
        manifests = [i for i in infos if i.base_name.startswith("_manifest-")]
        named = set()
        for info in manifests:
            with system.open_input_stream(info.path) as file:
                named |= set(json.loads(file.read()))
        files = [
            i for i in infos
            if (i.base_name in named if manifests else i.base_name.endswith((".warc", ".warc.gz")))
        ]
        parts, held = [[]], 0
        for info in sorted(files, key=lambda i: i.path):
            if parts[-1] and held + info.size > self.partition_bytes:
                parts.append([])
                held = 0
            parts[-1].append(info.path)
            held += info.size
        return [Files(tuple(part)) for part in parts]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = storage(self.path)
        arrow, names = to_arrow_schema(self.schema), self.schema.names

        def wanted(row: dict) -> bool:
            return all(_holds(row[column], how, value) for column, how, value in self.tests)

        rows, held = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as file:
                try:
                    for row in records(Stream(file), names, wanted):
                        rows.append(row)
                        held += len(row.get("payload") or b"")
                        if len(rows) >= _BATCH_ROWS or held >= _BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
                except (ValueError, KeyError, zlib.error) as error:
                    raise ValueError(f"{path}: {error}") from error
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)


def _test(f: Filter) -> tuple[str, str, object] | None:
    """A filter as (column, comparison, value) if it is on a column that headers tell."""
    how = {EqualTo: "=", In: "in", IsNotNull: "known", IsNull: "unknown", StringStartsWith: "starts"}
    negated = isinstance(f, Not)
    inner = f.child if negated else f
    if type(inner) not in how or len(inner.attribute) != 1:
        return None
    if inner.attribute[0] not in {*HEADERS, "payload_digest", "content_length"}:
        return None
    value = getattr(inner, "value", None)
    return inner.attribute[0], ("not " if negated else "") + how[type(inner)], value


def _holds(found, how: str, value) -> bool:
    if how.startswith("not "):
        plain = how.removeprefix("not ")
        return (plain in ("known", "unknown") or found is not None) and not _holds(
            found, plain, value
        )
    if how in ("known", "unknown"):
        return (found is None) == (how == "unknown")
    if found is None:
        return False
    if how == "=":
        return found == value
    return found in value if how == "in" else found.startswith(value)


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.file_bytes = int(options.get("file_bytes", 256 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = storage(self.path)
        system.create_dir(path, recursive=True)
        names, file, size = [], None, 0
        try:
            for batch in iterator:
                # A row at a time: a batch of long payloads is not copied as a whole.
                for i in range(batch.num_rows):
                    row = {n: batch.column(n)[i].as_py() for n in RECORDS.names}
                    if file is None:
                        names.append(f"{uuid.uuid4().hex}.warc.gz")
                        file, size = system.open_output_stream(
                            f"{path}/{names[-1]}", compression=None
                        ), 0
                    size += file.write(packed := member(record(row))) or len(packed)
                    if size >= self.file_bytes:
                        file.close()
                        file = None
        finally:
            if file is not None:
                file.close()
        return Written(tuple(names))

    def commit(self, messages: list) -> None:
        system, path = storage(self.path)
        system.create_dir(path, recursive=True)
        names = [name for m in messages if m is not None for name in m.names]
        earlier = []
        if self.overwrite:
            infos = system.get_file_info(fs.FileSelector(path))
            earlier = [i for i in infos if i.type == fs.FileType.File and i.base_name not in names]
        with system.open_output_stream(f"{path}/_manifest-{uuid.uuid4().hex}") as file:
            file.write(json.dumps(names).encode())
        # Manifests first: what they name must be there as long as they are.
        for info in sorted(earlier, key=lambda i: not i.base_name.startswith("_manifest-")):
            system.delete_file(info.path)

    def abort(self, messages: list) -> None:
        system, path = storage(self.path)
        for m in messages:
            for name in m.names if m is not None else ():
                system.delete_file(f"{path}/{name}")


# --- operators ---------------------------------------------------------------


def read(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The records under a folder, as these columns of SCHEMA (all unless named).

    Columns of other names, missing headers: none, null. Payloads are decoded only if ``payload``
    or ``intact`` is among the columns and a record passes the filters on header columns. Without
    files there are no rows. A damaged file fails the read and is named. Payloads are the bytes as
    transferred, up to 2 GB, one record at a time.
    """
    spark.dataSource.register(Archive)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    size = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes").removesuffix("b")
    ))
    asked = T.StructType([SCHEMA[c] for c in columns or SCHEMA.names])
    return spark.read.format("warc").schema(asked).option("partition_bytes", size).load(path)


def write(rows: DataFrame, path: str, file_bytes: int = 256 << 20) -> None:
    """Append rows of RECORDS (other columns are left out) as compressed records."""
    rows.sparkSession.dataSource.register(Archive)
    rows.select(*RECORDS.names).write.format("warc").mode("append").option(
        "file_bytes", file_bytes
    ).save(path)


def deduplicated(
    pages: DataFrame, *, key: str = "page_id", url: str = "url", body: str = "html",
    least: int = 0, crowd: int = 1000, name: str = "page",
) -> DataFrame:
    """RECORDS, one for each page: a response, or a revisit of the one with an equal payload.

    Of equal payloads (UTF-8 of the body, null: empty) of ``least`` bytes or more the row with the
    largest key is the response, and rows that repeat that key are responses too. A null key is
    the smallest. Shorter payloads are all responses. A null URL makes no header, line breaks in a
    URL are percent-encoded. An empty table gives no records; other columns are left out.

    Payloads are known by length and SHA-256. Those that are shared by more than one row in
    ``crowd`` are at most ``crowd``, so they are broadcast; rows of others, of which none is
    crowded, are joined.
    """
    payload = F.encode(F.coalesce(F.col(f"`{body}`"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{url}`").alias("target_uri"),
        payload.alias("payload"),
    ).withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"),
        "same": F.sha2("payload", 256),
    })
    shared = cut(
        rows.where(F.col("payload_bytes") >= least)
        .groupBy("same", F.col("payload_bytes").alias("size"))
        .agg(F.max("id").alias("best"), F.count("*").alias("n"))
        .where("n > 1")
    )
    many = F.col("n") * crowd > pages.count()
    crowded = shared.where(many).select(
        F.col("same"), F.col("best").alias("crowd_best"), F.col("n").alias("crowd_n")
    )
    # Rows of crowded payloads are dealt out: they have no partner in the second join.
    alone = F.concat(F.lit("-"), F.xxhash64("id", "target_uri").cast("string"))
    found = (
        rows.join(F.broadcast(crowded), "same", "left")
        .withColumn("other", F.when(F.col("crowd_n").isNull(), F.col("same")).otherwise(alone))
        .join(shared.where(~many).select(F.col("same").alias("other"), "best", "n"), "other", "left")
    )
    best = F.coalesce("best", "crowd_best")
    response = F.coalesce("n", "crowd_n").isNull() | F.col("id").eqNullSafe(best)
    kept = F.when(response, F.col("payload"))

    def record_id(of):
        return F.concat(F.lit(f"<urn:{name}:"), F.coalesce(of.cast("string"), F.lit("")), F.lit(">"))

    return found.select(
        record_id(F.col("id")).alias("record_id"),
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        "target_uri",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.when(~response, record_id(best)).alias("refers_to"),
        F.sha1("payload").alias("sha1"),
        "payload_bytes",
        kept.alias("payload"),
    )


def archived(spark: SparkSession, path: str, *, key: str = "page_id", name: str = "page"
             ) -> DataFrame:
    """What ``deduplicated`` rows became as an archive, read back: the keys, payload lengths and
    digests, types, whom revisits refer to, and whether payloads match their digests."""

    def id_of(column):
        text = F.regexp_extract(column, f"^<urn:{name}:(-?[0-9]+)>$", 1)
        return F.nullif(text, F.lit("")).cast("long")

    found = read(
        spark, path, "record_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        "intact",
    )
    return found.select(
        id_of("record_id").alias(key), "payload_bytes", "payload_digest", "record_type",
        id_of("refers_to").alias("refers_to"), "intact",
    )
