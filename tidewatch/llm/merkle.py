"""A Merkle tree over a table, a subtree for each group, with a proof for every row.

Where a row's leaf stands in its group follows from rank queries on bitmaps, not from sorting the
rows. A group's keys are a bitmap of 64-bit words, of which only those with a bit are kept. They
are merged by OR, on the map side first. A popcount directory in three steps (word, chunk of 1024
words, stretch of 1024 chunks) tells how many rows stand before a word; the bits below its own
tell a row the rest. So what has to be in order is words, at most 1024 at once. Keys that repeat
do not fit a bitmap: their words are marked, and only their rows are ranked by leaf.

Levels are then reduced by keyed slots: a node's parent is its place divided by the fan-out, its
slot the remainder, and a parent puts its children into an array by slot. Proofs come from the top
down: a node hands its path on to its children, which are in the same row, so that paths are
shuffled once for every sixteen rows.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import remove_folder, work_folder
from .common import cut

FANOUT = 16
_STEP = 10  # a directory entry covers 2**10 of the step below
#: Rows of a repeated key are ranked within ranges of their leaves: so many hexadecimal digits.
_RANGE = 3


def prefixed(value: Column) -> Column:
    """A value as the leaf hashes it: ``-`` if null, else its length in bytes, ``:``, and itself."""
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")
    )


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[prefixed(v) for v in values]), 256)


def _hash(digests: Column) -> Column:
    """The hash of an array of digests, joined as text."""
    return F.sha2(F.array_join(digests, ""), 256)


# --- places ------------------------------------------------------------------


def _from_bit(word: int) -> Column:
    """A word shifted up to this row's bit."""
    return F.call_function("shiftleft", F.lit(word).cast("long"), F.col("bit"))


def _before(n: str, *keys: str, order: str) -> Column:
    """Running total of n before this row."""
    window = Window.partitionBy(*keys).orderBy(order)
    return F.sum(n).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(n)


def _directory(rows: DataFrame) -> DataFrame:
    """(grp, word, bits, regular, base): each word's bits and how many rows stand before it."""
    words = cut(
        rows.groupBy("grp", "word")
        .agg(F.bit_or(_from_bit(1)).alias("bits"),
             F.sum("copies").alias("n"), F.bool_or(F.col("key").isNull()).alias("no_key"))
        .withColumn("chunk", F.shiftright("word", _STEP))
        .withColumn("stretch", F.shiftright("word", 2 * _STEP))
    )
    chunks = words.groupBy("grp", "stretch", "chunk").agg(F.sum("n").alias("n"))
    stretches = chunks.groupBy("grp", "stretch").agg(F.sum("n").alias("n"))
    at_stretch = stretches.select(
        "grp", "stretch", _before("n", "grp", order="stretch").alias("b0"),
    )
    at_chunk = chunks.select(
        "grp", "stretch", "chunk", _before("n", "grp", "stretch", order="chunk").alias("b1")
    )
    in_chunk = words.withColumn("b2", _before("n", "grp", "chunk", order="word"))
    regular = ~F.col("no_key") & (F.bit_count("bits") == F.col("n"))
    return in_chunk.join(at_chunk, ["grp", "stretch", "chunk"]).join(
        at_stretch, ["grp", "stretch"]
    ).select(
        "grp", "word", "bits", regular.alias("regular"),
        (F.col("b0") + F.col("b1") + F.col("b2")).alias("base"),
    )


def places(rows: DataFrame) -> DataFrame:
    """The rows (grp string, key long, leaf, copies, more) with their first place ``at``.

    Within a group rows ascend by key, null first, then by leaf; a row takes ``copies`` places.
    Equal (grp, key, leaf) must be one row. ``grp`` must not be null.
    """
    # The lowest word there could be is far below those of actual keys.
    word = F.coalesce(F.shiftright("key", 6), F.lit(-(2**63)))
    bit = F.coalesce(F.col("key").bitwiseAND(63), F.lit(0)).cast("int")
    keyed = rows.withColumns({"word": word, "bit": bit})
    directory = cut(_directory(keyed))
    found = keyed.join(directory, ["grp", "word"])
    below = F.bitwise_not(_from_bit(-1))
    rank = F.col("base") + F.bit_count(F.col("bits").bitwiseAND(below))
    more = [c for c in rows.columns]
    placed = found.where("regular").select(*more, rank.cast("long").alias("at"))
    if directory.where(~F.col("regular")).isEmpty():
        return placed

    # Words with repeated keys: counts by (key, range of leaves), then within one range.
    crowded = found.where(~F.col("regular")).withColumn("range", F.left("leaf", F.lit(_RANGE)))
    ranges = crowded.groupBy("grp", "word", "bit", "range").agg(F.sum("copies").alias("n"))
    ordered = Window.partitionBy("grp", "word").orderBy("bit", "range")
    started = ranges.withColumn("before", F.sum("n").over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).drop("n")
    inside = _before("copies", "grp", "word", "bit", "range", order="leaf")
    rest = crowded.withColumn("inside", inside).join(started, ["grp", "word", "bit", "range"])
    return placed.union(
        rest.select(*more, (F.col("base") + F.col("before") + F.col("inside")).alias("at"))
    )


# --- levels ------------------------------------------------------------------


@dataclass
class Tree:
    """Level tables, lowest first, of (grp, at, n, digest, kids), and the tops (grp, digest)."""

    levels: list[DataFrame]
    tops: DataFrame


def reduce(nodes: DataFrame) -> Tree:
    """Reduce nodes (grp, at, n, digest, more), n of them in each group, to one for each group.

    The lowest level keeps all columns of its children in ``kids``, the others keep digests. A
    group of one node is its own top. Each level is a table in the shared folder.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    more = [c for c in nodes.columns if c not in ("grp", "at", "n")]
    now, levels, tops = nodes, [], [nodes.where("n = 1").select("grp", "digest")]
    while most > 1:
        slot = F.pmod("at", F.lit(FANOUT)).cast("int")
        entry = F.struct(slot, F.struct(*[F.col(c) for c in more]))
        slots = F.map_from_entries(F.collect_list(entry))
        kept = now.where("n > 1").groupBy(
            "grp", F.floor(F.col("at") / FANOUT).alias("at"), "n"
        ).agg(slots.alias("slots"))
        by_slot = F.transform(
            F.sequence(F.lit(0), F.size("slots") - 1), lambda i: F.col("slots")[i]
        )
        level = cut(
            kept.withColumn("kids", by_slot)
            .withColumn("digest", _hash(F.col("kids.digest")))
            .select("grp", "at", F.ceil(F.col("n") / FANOUT).alias("n"), "digest", "kids")
        )
        levels.append(level)
        now, more = level.select("grp", "at", "n", "digest"), ["digest"]
        tops.append(now.where("n = 1").select("grp", "digest"))
        most = -(-most // FANOUT)
    whole = tops[0]
    for top in tops[1:]:
        whole = whole.union(top)
    return Tree(levels, whole)


def paths(tree: Tree, tops: DataFrame) -> DataFrame:
    """Tops (grp, path, more) carried down to the children of the lowest level: (kid, more, path).

    A path is an array from the node upwards of what stands left and right of it, as bytes. The
    columns of the lowest children are in ``kid``. Groups of one node have no level and no row.
    """
    more = [c for c in tops.columns if c not in ("grp", "path")]
    now = None
    for level in reversed(tree.levels):
        # A group's top is where its level has one node.
        top = level.where("n = 1").join(tops, "grp")
        below = level.where("n > 1")
        parents = top if now is None else top.unionByName(below.join(now, ["grp", "at"]))
        at_kid = parents.select(
            "grp", "at", "path", *more, F.col("kids.digest").alias("all"), F.posexplode("kids")
        )
        bytes_of = lambda part: F.unhex(F.array_join(part, ""))
        step = F.struct(
            bytes_of(F.slice("all", F.lit(1), F.col("pos"))).alias("left"),
            bytes_of(F.slice("all", F.col("pos") + 2, F.lit(FANOUT))).alias("right"),
        )
        now = at_kid.select(
            "grp", (F.col("at") * FANOUT + F.col("pos")).alias("at"), F.col("col").alias("kid"),
            *more, F.concat(F.array(step), F.col("path")).alias("path"),
        )
        lowest = level is tree.levels[0]
        now = now if lowest else now.drop("kid")
    return now


def _text(part: Column) -> Column:
    return F.lower(F.hex(part))


def proof_hash(path: Column) -> Column:
    """The hash of all siblings on a path."""
    return F.sha2(
        F.array_join(F.transform(path, lambda s: F.concat(_text(s.left), _text(s.right))), ""), 256
    )


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(
        path, start, lambda acc, s: F.sha2(F.concat(_text(s.left), acc, _text(s.right)), 256)
    )


# --- the operator ------------------------------------------------------------


def _in_order(tops: DataFrame) -> DataFrame:
    """The groups with their places in order of name, as nodes of one tree.

    Sorted by range; a partition's groups follow those of the partitions before it.
    """
    dealt = F.monotonically_increasing_id()
    placed = cut(tops.orderBy("grp").withColumn("dealt", dealt))
    part = F.shiftright("dealt", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row for each partition of the sort.
    before = counts.select("part", _before("n", F.lit(0), order="part").alias("before"))
    total = F.lit(placed.count()).cast("long").alias("n")
    within = F.col("dealt").bitwiseAND((1 << 33) - 1)
    return placed.withColumn("part", part).join(F.broadcast(before), "part").select(
        F.lit("").alias("grp"), (F.col("before") + within).alias("at"), total, "digest",
        F.col("grp").alias("of"),
    )


def manifest(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    group: str = "source",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """(key, group, leaf, subroot, root, proof_sha256, folded_root, verified), one row a document.

    A leaf hashes the columns in order, each with its length, null as ``-``. In a group (null is
    one, the first) leaves ascend by key, null first; rows that share a key ascend by leaf, and
    equal rows stand side by side, each with its own place. Groups of one leaf have it as subroot.
    Subroots, by UTF-8 bytes of the group's name, make the root likewise. ``tampered`` maps
    columns to what they were changed to after the tree was built; ``folded_root`` is what a
    changed row and its stored proof lead to. Texts of any length are hashed whole. An empty table
    has no rows; other columns are left out, whatever their names.
    """
    changed = tampered or {}
    col = {c: F.col(f"`{c}`") for c in {*columns, key, group}}
    name = F.coalesce(F.concat(F.lit("="), col[group]), F.lit(""))
    sealed = leaf(*[col[c] for c in columns])
    now = leaf(*[changed.get(c, col[c]) for c in columns]) if changed else sealed
    hashed = docs.select(
        name.alias("grp"), col[key].cast("long").alias("key"), sealed.alias("leaf"),
        now.alias("now"),
    )
    folder = work_folder(docs.sparkSession, "leaves")
    # Texts are read and hashed once. Rows that are equal in all columns become one.
    hashed.groupBy("grp", "key", "leaf", "now").agg(F.count("*").alias("copies")).write.parquet(
        folder
    )
    leaves = docs.sparkSession.read.parquet(folder)
    sizes = leaves.groupBy("grp").agg(F.sum("copies").alias("n"))
    each = F.explode(F.sequence(F.col("at"), F.col("at") + F.col("copies") - 1))
    nodes = places(leaves).join(sizes, "grp").select(
        "grp", each.alias("at"), "n", F.col("leaf").alias("digest"), "key", "now"
    )
    nodes = cut(nodes)
    remove_folder(docs.sparkSession, folder)

    groups = reduce(nodes)
    over = reduce(cut(_in_order(groups.tops)))
    root = over.tops.select(F.col("digest").alias("root"))
    no_path = F.array().cast("array<struct<left:binary,right:binary>>")
    if over.levels:
        tops = paths(over, over.tops.select("grp", F.col("digest").alias("root"),
                                            no_path.alias("path")))
        subroots = tops.select(F.col("kid.of").alias("grp"), F.col("kid.digest").alias("subroot"),
                               "root", "path")
    else:  # a single group, or none
        subroots = groups.tops.select("grp", F.col("digest").alias("subroot"),
                                      F.col("digest").alias("root"), no_path.alias("path"))
    subroots = cut(subroots)
    single = nodes.where("n = 1").join(subroots, "grp").select(
        "grp", "key", F.col("digest").alias("leaf"), "now", "subroot", "root", "path"
    )
    if groups.levels:
        lower = paths(groups, subroots)
        single = single.unionByName(lower.select(
            "grp", F.col("kid.key").alias("key"), F.col("kid.digest").alias("leaf"),
            F.col("kid.now").alias("now"), "subroot", "root", "path",
        ))
    done = single.withColumn("folded_root", folded(F.col("now"), F.col("path")))
    return done.select(
        F.col("key").alias(key),
        F.when(F.col("grp") != "", F.substring("grp", 2, 2**31 - 1)).alias(group),
        "leaf", "subroot", "root",
        proof_hash(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
