import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD_TEXTS, documents
from tidewatch.llm import merkle
from tidewatch.llm.common import lower_ascii


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    def part(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    return sha("".join(map(part, (doc_id, source, lang, n_chars, text))))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, at):
    out = []
    for level in tree[:-1]:
        first = at // 16 * 16
        out.append(("".join(level[first:at]), "".join(level[at + 1:first + 16])))
        at //= 16
    return out


def lowered(doc_id, text):
    if doc_id is None or text is None or zlib.crc32(str(doc_id).encode()) % 5:
        return text
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows):
    """The manifest of (doc_id, text, lang, source, n_chars) rows by plain trees."""
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda m: m[:3]) for g in names}
    trees = {g: levels([m[2] for m in ordered[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for i, g in enumerate(names):
        for at, (_, _, digest, row) in enumerate(ordered[g]):
            path = siblings(trees[g], at) + siblings(top, i)
            now = leaf(row[0], lowered(*row[:2]), *row[2:])
            for left, right in path:
                now = sha(left + now + right)
            out.append((row[0], g, digest, trees[g][-1][0], top[-1][0],
                        sha("".join(a + b for a, b in path)), now, now == top[-1][0]))
    return sorted(out, key=str)


def bent():
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return {"text": F.when(touched, lower_ascii(F.col("text"))).otherwise(F.col("text"))}


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 17, 257])
def test_trees_of_every_shape(spark, n):
    rows = [(7 * i, f"Text {i}", "en", "only", 6) for i in range(n)]
    assert found(merkle.manifest(documents(spark, rows), tampered=bent())) == plain(rows)


def test_many_groups_odd_keys_and_texts(spark):
    rnd = random.Random(4)
    far = [None, 0, -1, -64, 63, 64, 2**62, -(2**63), 2**63 - 1, *range(1000, 1070)]
    rows = [(rnd.choice(far), rnd.choice(ODD_TEXTS), rnd.choice(["en", None]),
             rnd.choice([None, "", "é", "z", "a b", *map(str, range(20))]), rnd.choice([None, 1]))
            for _ in range(600)]
    # Equal rows, one key that holds a third of all, and groups of one row.
    rows += [(5, "Hot", "en", "a b", 3)] * 40 + [(6, f"T{i}", "en", "a b", 3) for i in range(300)]
    rows += [(i, "x", "en", f"single {i}", 1) for i in range(280)]
    assert found(merkle.manifest(documents(spark, rows), tampered=bent())) == plain(rows)


def test_untouched_rows_verify_and_order_of_input_does_not_matter(spark):
    rows = [(i, f"Text {i}", "en", str(i % 3), 6) for i in range(100)]
    docs = documents(spark, rows)
    got = merkle.manifest(docs)
    assert got.where("NOT verified").count() == 0
    again = merkle.manifest(documents(spark, rows[::-1]).repartition(7))
    assert found(got) == found(again)


def test_clashing_columns_are_left_out(spark):
    rows = [(i, f"Text {i}", "en", str(i % 3), 6) for i in range(40)]
    docs = documents(spark, rows)
    names = ["grp", "key", "leaf", "now", "word", "bit", "at", "n", "kids", "path", "root"]
    wide = docs.withColumns({name: F.lit("x") for name in names})
    assert found(merkle.manifest(wide)) == found(merkle.manifest(docs))


def test_places_need_no_sort_of_the_rows(spark):
    """Ranks come of bitmaps: no plan step orders rows with leaves."""
    rows = spark.range(100_000).selectExpr(
        "concat('=', id % 3) AS grp", "id * 37 % 1000003 AS key", "sha2(string(id), 256) AS leaf",
        "1L AS copies")
    placed = merkle.places(rows)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    wrong = placed.selectExpr(
        "at", "row_number() OVER (PARTITION BY grp ORDER BY key) - 1 AS want").where("at <> want")
    assert wrong.count() == 0
