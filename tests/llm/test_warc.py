import base64
import gzip
import hashlib
import io
import random

import pytest

from tests.llm.helpers import ODD_TEXTS
from tidewatch.llm import warc
from tidewatch.session import work_folder

PAGE = "page_id long, url string, html string"


def pages(spark, rows, schema=PAGE):
    return spark.createDataFrame(rows, schema)


def round_trip(spark, frame, file_bytes=256 << 20, **settings):
    folder = work_folder(spark, "warc")
    warc.write(warc.deduplicated(frame, **settings), folder, file_bytes)
    return folder


def expected(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) of each row, in plain Python."""
    best, size = {}, {}
    for key, _, html in rows:
        body = (html or "").encode()
        size[body] = size.get(body, 0) + 1
        best[body] = max(best.get(body, (False, 0)), (key is not None, key or 0))
    out = []
    for key, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        known, top = best[body]
        first = len(body) < least or (key is not None, key or 0) == (known, top)
        out.append((key, len(body), digest, "response" if first else "revisit",
                    None if first else top))
    return sorted(out, key=str)


def found(frame):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=str)


def test_archives_equal_a_plain_version(spark):
    rnd = random.Random(3)
    bodies = [*ODD_TEXTS, *[f"<p>{i}</p>" * (i + 1) for i in range(12)]]
    rows = [(rnd.choice([None, *range(60)]), rnd.choice([None, "", "http://a/é b", "x\r\ny"]),
             rnd.choice(bodies)) for _ in range(200)]
    # One payload holds a third of all rows.
    rows += [(100 + i, "u", "hot") for i in range(100)]
    for crowd in (1, 1000):
        folder = round_trip(spark, pages(spark, rows), crowd=crowd)
        got = warc.archived(spark, folder)
        assert found(got) == expected(rows)
        assert {(r.record_type, r.intact) for r in got.collect()} == {
            ("response", True), ("revisit", None)
        }
    folder = round_trip(spark, pages(spark, rows), least=10)
    assert found(warc.archived(spark, folder)) == expected(rows, least=10)


def test_payloads_come_back_whole(spark):
    rows = [(i, f"u{i}", text) for i, text in enumerate(ODD_TEXTS)]
    folder = round_trip(spark, pages(spark, rows), file_bytes=1)
    got = warc.read(spark, folder).where("record_type = 'response'")
    assert {bytes(r.payload).decode() for r in got.collect()} == {t or "" for t in ODD_TEXTS}


def test_empty_table_and_extra_columns(spark):
    folder = round_trip(spark, pages(spark, []))
    assert warc.archived(spark, folder).collect() == []
    clash = "page_id long, url string, html string, same string, best long, n long, payload int"
    rows = [(1, "u", "a", "s", 1, 1, 1), (2, "u", "a", "s", 1, 1, 1)]
    folder = round_trip(spark, pages(spark, rows, clash))
    assert found(warc.archived(spark, folder)) == expected([r[:3] for r in rows])


def test_header_predicates_reach_the_reader(spark):
    rows = [(i, f"http://h{i % 3}/{i}", "same" if i % 2 else f"own {i}") for i in range(30)]
    folder = round_trip(spark, pages(spark, rows))
    some = warc.read(spark, folder, "record_id", "record_type", "target_uri").where(
        "record_type = 'revisit' AND target_uri LIKE 'http://h1/%'"
    )
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")
    assert {r.record_id for r in some.collect()} == {
        f"<urn:page:{i}>" for i in range(29) if i % 2 and i % 3 == 1
    }
    everything = warc.read(spark, folder)
    for test in ("record_type <> 'response'", "refers_to IS NULL", "refers_to IS NOT NULL",
                 "NOT refers_to = '<urn:page:29>'", "record_type IN ('revisit', 'x')",
                 "payload_bytes > 4", "NOT target_uri LIKE 'http://h1/%'"):
        table = spark.createDataFrame(everything.collect(), everything.schema)
        assert everything.where(test).count() == table.where(test).count(), test


class Counting(io.BytesIO):
    """A file that counts what is read of it."""

    total = 0

    def read(self, n=-1):
        got = super().read(n)
        self.total += len(got)
        return got


def record(i, size, kind="response"):
    body = random.Random(i).randbytes(size)
    return warc.record({
        "record_id": f"<urn:page:{i}>", "record_type": kind, "target_uri": f"u{i}", "date": "d",
        "refers_to": None, "sha1": hashlib.sha1(body).hexdigest(), "payload_bytes": size,
        "payload": body,
    })


@pytest.mark.parametrize("packed", [False, True])
def test_unwanted_payloads_are_not_read(packed):
    made = [record(i, 4_000_000) for i in range(5)]
    file = Counting(b"".join(warc.member(m) if packed else m for m in made))
    rows = list(warc.records(warc.Stream(file), ["record_id", "payload_bytes"]))
    assert [r["record_id"] for r in rows] == [f"<urn:page:{i}>" for i in range(5)]
    assert {r["payload_bytes"] for r in rows} == {4_000_000}
    assert file.total < 5 * 1_000_000
    one = list(warc.records(warc.Stream(file), ["payload", "intact"],
                            lambda row: row["record_id"] == "<urn:page:3>"))
    assert len(one) == 1 and one[0]["intact"] and len(one[0]["payload"]) == 4_000_000


def test_archives_of_others():
    """Members without lengths, several records in a member, no HTTP block, folded headers."""
    plain = (b"WARC/1.0\r\nWARC-Type: warcinfo\r\nX: a\r\n b\r\nContent-Length: 3\r\n\r\nabc"
             b"\r\n\r\n")
    whole = plain + record(1, 100) + plain
    for data in (whole, gzip.compress(whole), gzip.compress(plain) + gzip.compress(record(1, 100))
                 + gzip.compress(plain)):
        rows = list(warc.records(warc.Stream(io.BytesIO(data)), ["record_type", "payload",
                                                                 "payload_bytes", "intact"]))
        assert [(r["record_type"], r["payload_bytes"], r["intact"]) for r in rows] == [
            ("warcinfo", 3, None), ("response", 100, True), ("warcinfo", 3, None)
        ]
        assert rows[0]["payload"] == b"abc"
    assert warc.fields(plain)["x"] == "a b"
    assert gzip.decompress(warc.member(whole)) == whole
    for broken in (whole[:-50], gzip.compress(whole)[:-50], b"junk\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.records(warc.Stream(io.BytesIO(broken)), ["payload"]))


def test_only_finished_writes_are_read(spark, tmp_path):
    folder = round_trip(spark, pages(spark, [(1, "u", "a")]))
    system, path = warc.storage(folder)
    with system.open_output_stream(f"{path}/left-behind.warc") as file:
        file.write(record(9, 10))
    assert found(warc.archived(spark, folder)) == expected([(1, "u", "a")])
    (tmp_path / "x.warc").write_bytes(record(9, 10))
    (tmp_path / "y.warc.gz").write_bytes(warc.member(record(8, 10)))
    (tmp_path / "notes.txt").write_text("no archive")
    assert {r.page_id for r in warc.archived(spark, str(tmp_path)).collect()} == {8, 9}


def test_small_files_share_a_task_large_ones_do_not(tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.warc").write_bytes(record(i, 1000 if i else 100_000))
    reader = warc.ArchiveReader({"path": str(tmp_path), "partition_bytes": "5000"}, warc.SCHEMA)
    assert [len(p.paths) for p in reader.partitions()] == [1, 3, 2]
