"""Mixing sources to target weights by Pareto order sampling.

Targets share the wanted words among sources by weight; no target exceeds ``most`` times its
source. A document's expected copies grow with the square root of its size, within a source by
one factor, and stop at ``most``. Their whole part is certain. The rest is the inclusion
chance p of one more copy: documents are ranked by random odds over inclusion odds,
(u / (1 - u)) / (p / (1 - p)), and the lowest ranks are taken until the source has its words.

No source is ever sorted as a whole. The factor comes from a histogram of sizes for each
source, summed over blocks of ``BLOCK`` sizes and within them, in one pass each; the cut from word sums over ``BUCKETS`` intervals of the rank; only the documents of the
one interval that holds the cut are ordered. What then decides is one row for each source.
"""

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .common import cut, own_names, restored, shielded, sized, word_count

BUCKETS = 1 << 14
BLOCK = 64
_UNIT = float(1 << 52)


def targets(sizes: DataFrame, *, weights=(3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources in code point order, null last, take the weights in turn. Sources whose share would
    exceed ``most`` times their size stop there; what is over goes to the others by weight,
    until none is above. One row for each source, so the windows are as long as their list.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    weighed = sizes.select("source", "source_size", turn.alias("turn"), weight.alias("weight"))
    cap = (most * F.col("source_size")).cast("decimal(38,0)")
    # Sources reach their limit in the order of limit over weight.
    order = Window.orderBy((cap.cast("double") / F.col("weight")), "turn")
    before = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = Window.partitionBy()
    # Frames that begin with the first row are summed in one pass.
    passed = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    left = F.sum("weight").over(every) - passed + F.col("weight")
    wanted = share * F.sum("source_size").over(every).cast("double")
    level = (wanted - before.cast("double")) / left
    filled = weighed.select(
        "*", cap.cast("double").alias("cap"), level.alias("level"),
        F.row_number().over(order).alias("place"),
    )
    free = F.col("cap") / F.col("weight") > F.col("level")
    common = F.min_by("level", F.when(free, F.col("place"))).over(every)
    return filled.select(
        "source",
        "source_size",
        F.coalesce(F.least("cap", F.col("weight") * common), F.col("cap")).alias("target"),
    )


def _pull(size: Column) -> Column:
    """Relative claim to copies: the square root of the size, as an integer."""
    return F.floor(1024 * F.sqrt(size.cast("double")))


def _factors(histogram: DataFrame, goals: DataFrame, most: int) -> DataFrame:
    """(source, source_size, target, factor, rest): copies are min(most, factor * pull);
    ``rest`` are the words that certain copies leave to be drawn."""
    small = sized(goals.withColumnRenamed("source", "_of"))
    wide = histogram.join(small, F.col("source").eqNullSafe(F.col("_of"))).select(
        "source", "source_size", "target", "size", _pull(F.col("size")).alias("pull"),
        (F.col("size") * F.col("n")).cast("decimal(38,0)").alias("mass"),
    )
    wide = cut(wide.select(
        "*", (F.col("mass") * F.col("pull")).cast("decimal(38,0)").alias("claim"),
        F.floor(F.col("size") / BLOCK).alias("block"),
    ))

    def ahead(column: str, within: WindowSpec) -> Column:
        """Sum over the longer ones; whole numbers, so exact in any order."""
        before = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.sum(column).over(before) - F.col(column)

    longest = Window.partitionBy("source").orderBy(F.col("block").desc())
    blocks = wide.groupBy("source", "block").agg(
        F.sum("mass").cast("decimal(38,0)").alias("m"), F.sum("claim").cast("decimal(38,0)").alias("c")
    ).select(
        F.col("source").alias("_of"), F.col("block").alias("_block"),
        ahead("m", longest).alias("m"), ahead("c", longest).alias("c"),
        F.sum("c").over(Window.partitionBy("source")).alias("total"),
    )
    inside = Window.partitionBy("source", "block").orderBy(F.col("size").desc())
    summed = wide.withColumns({"m_in": ahead("mass", inside), "c_in": ahead("claim", inside)}).join(
        blocks, F.col("source").eqNullSafe(F.col("_of")) & (F.col("block") == F.col("_block"))
    )
    full = F.col("m") + F.col("m_in")
    claim = F.col("total") - F.col("c") - F.col("c_in")
    factor = (F.col("target") - most * full.cast("double")) / F.nullif(claim, F.lit(0)).cast("double")
    tried = summed.select("source", "source_size", "target", "size", "pull", factor.alias("tried"))
    free = F.col("tried") * F.col("pull") < most
    chosen = F.max_by("tried", F.when(free, F.col("size")))
    settled = cut(tried.groupBy("source", "source_size", "target").agg(
        F.coalesce(chosen, F.lit(float("inf"))).alias("factor")
    ))
    small = sized(settled.select(F.col("source").alias("_of"), "factor"))
    certain = F.floor(_copies(F.col("factor"), F.col("size"), most))
    held = wide.join(small, F.col("source").eqNullSafe(F.col("_of"))).groupBy("_of").agg(
        F.sum(certain * F.col("mass")).cast("double").alias("certain")
    )
    return settled.join(held, F.col("source").eqNullSafe(F.col("_of"))).select(
        "source", "source_size", "target", "factor", (F.col("target") - F.col("certain")).alias("rest")
    )


def _copies(factor: Column, size: Column, most: int) -> Column:
    """Expected copies of a document."""
    drawn = F.when(size > 0, F.least(F.lit(float(most)), factor * _pull(size)))
    return F.coalesce(drawn, F.lit(0.0))


def _chance(key: Column, seed: int) -> Column:
    """Uniform in (0, 1), from the key alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / _UNIT


def _rank(chance: Column, expected: Column) -> Column:
    """Random odds over inclusion odds, null where nothing is drawn."""
    p = expected - F.floor(expected)
    return F.when(p > 0, (chance / (1 - chance)) / (p / (1 - p)))


def _drawn(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    return own_names(
        docs,
        _source=F.col(f"`{source}`"),
        size=word_count(F.col(f"`{text}`")),
        _chance=_chance(F.col(f"`{key}`"), seed),
        _lot=F.struct(
            F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(0)).alias("key"),
            F.xxhash64(F.col(f"`{text}`")).alias("hash"),
        ),
    )


def plan(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=(3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 7,
) -> DataFrame:
    """One row for each source: its target, its factor and the last rank that is taken."""
    slim = docs.select(*dict.fromkeys(f"`{c}`" for c in (key, text, source)))
    narrow = cut(
        _drawn(slim, key, text, source, seed).select(
            F.col("_source").alias("source"), "size", "_chance", "_lot"
        )
    )
    histogram = narrow.groupBy("source", "size").agg(F.count("*").alias("n"))
    sizes = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = cut(targets(sizes, weights=weights, share=share, most=most))
    factors = cut(_factors(histogram, goals, most))

    small = sized(factors.withColumnRenamed("source", "_of"))
    ranked = narrow.join(small, F.col("source").eqNullSafe(F.col("_of"))).select(
        "source", "size", "_lot", "rest",
        _rank(F.col("_chance"), _copies(F.col("factor"), F.col("size"), most)).alias("rank"),
    ).filter("rank IS NOT NULL")
    share_below = F.col("rank") / (1 + F.col("rank"))
    bucketed = ranked.withColumn("bucket", F.floor(share_below * BUCKETS))
    order = Window.partitionBy("source").orderBy("bucket")
    sums = (
        bucketed.groupBy("source", "rest", "bucket")
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.sum("words").over(order))
        .withColumn("before", F.col("upto") - F.col("words"))
    )
    # The interval in which the words run out, or the last one.
    edge = sums.filter("before < rest").groupBy("source").agg(
        F.max("bucket").alias("edge"), F.max("before").alias("before")
    )
    edge = sized(cut(edge.withColumnRenamed("source", "_of")))
    at_edge = bucketed.join(
        edge, F.col("source").eqNullSafe(F.col("_of")) & (F.col("bucket") == F.col("edge"))
    )
    units = at_edge.groupBy("source", "rest", "before", "rank", "_lot").agg(
        F.sum("size").alias("words")
    )
    ordered = Window.partitionBy("source").orderBy("rank", "_lot")
    ahead = F.col("before") + F.sum("words").over(ordered) - F.col("words") / 2
    taken = units.withColumn("middle", ahead).filter("middle <= rest")
    last = taken.groupBy("source").agg(F.max(F.struct("rank", "_lot")).alias("last"))
    low = F.col("edge").cast("double") / BUCKETS
    decided = (
        factors.join(edge, F.col("source").eqNullSafe(F.col("_of")), "left")
        .drop("_of")
        .join(last.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")), "left")
    )
    # If none of the edge's interval is taken, all ranks below it are.
    below = F.struct(
        (low / (1 - low)).alias("rank"),
        F.struct(F.lit(-(1 << 63)).cast("long").alias("key"), F.lit(0).cast("long").alias("hash")).alias("_lot"),
    )
    return cut(
        decided.select(
            "source", "source_size", "target", "factor",
            F.coalesce("last", F.when(F.col("edge").isNotNull(), below)).alias("last"),
        )
    )


def allot(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=(3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 7,
) -> DataFrame:
    """The documents with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``copies`` is how often the mix repeats a document, 0 to ``most``; ``taken`` are its words
    in the mix. A null text has size 0, and texts without words are taken 0 times. Null is a
    source like any other, last in order. Lots are drawn from the key and ties broken by key and
    text, so reruns agree; rows that repeat key and text share one lot and are taken alike.
    Input columns with the names above are replaced.
    """
    names = dict(key=key, text=text, source=source, seed=seed)
    planned = plan(docs, **names, weights=weights, share=share, most=most)
    decided = sized(planned.withColumnRenamed("source", "_of"))
    clash = {"source_size", "target", "factor", "last", "copies", "taken"}
    given = _drawn(docs, **names)
    kept = [F.col(f"`{c}`") for c in given.columns if c.lower() not in clash]
    joined = given.select(*kept).join(decided, F.col("_source").eqNullSafe(F.col("_of")))
    expected = _copies(F.col("factor"), F.col("size"), most)
    place = F.struct(_rank(F.col("_chance"), expected).alias("rank"), F.col("_lot").alias("_lot"))
    extra = F.coalesce((place["rank"].isNotNull() & (place <= F.col("last"))).cast("int"), F.lit(0))
    done = own_names(joined, copies=(F.floor(expected) + extra).cast("int"))
    done = done.drop("_source", "_chance", "_lot", "_of", "factor", "last")
    return own_names(done, taken=F.col("copies") * F.col("size"))


def mix(docs: DataFrame, *, key="doc_id", text="text", source="source", **parameters) -> DataFrame:
    """The mixed documents in the columns they came with, each as often as it is taken."""
    inner, name = shielded(docs)
    allotted = allot(inner, key=name[key], text=name[text], source=name[source], **parameters)
    spread = allotted.filter("copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))
    )
    return restored(spread, name)
