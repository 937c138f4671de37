"""A probabilistic suffix tree over words, grown in tables.

Word sequences are known by a 64-bit polynomial hash (sums of word hashes times powers of an odd
number, mixed), which running sums give for any place and length in one step. At 10^10 different
sequences two of them are likely to share one; their counts then add up.

A context is a candidate if it occurs ``least`` times. The tree grows by one word at a time, to the
left, and only where it still can: a context is open while the most that any longer form of it could
reach in the divergence test is above the smallest threshold. A word that follows n times, with
probability p in the context itself, adds at most n * log(min(1, n / least) / p) to a longer form, as that
has ``least`` occurrences; words not listed add together what one such word would. The bound falls or stays
with every further word, so what it closes holds no retained context: nothing is lost, no depth is set.

The first ``_GLOBAL`` lengths are counted over all texts. From then on all longer forms of an open
context are found among its own occurrences, so its windows (the preceding words, equal ones together
with their number) come together and grow by many lengths at a time, each time by more, and only texts
with open contexts are read again. Contexts with more occurrences than one group may hold grow
word by word by aggregation.

Counts move between tasks as parts: a row holds the sorted numbers of many sequences as bytes. Lengths 1 and 2 are
counted by the hashes of whole sequences, so that a frequent word's do not meet in one task; what occurs
often enough goes to its shorter form for its probability there and to its context, where it is tested.

Bitmaps that grow with what they hold, to 2^30 bits, tell which places can matter. They may pass too much, which
exact counts then drop; where a corpus fills them, more is moved, with the same result.
"""

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_folder, work_folder
from .common import batches

END = b""  # the end of a text, counted as a token
BEGIN = 0x9E3779B97F4A7C15  # the beginning of a text
FLUSH = 400_000
_ROWS = 1 << 19
SENT = 1 << 14  # rows of a batch on its way back
_AT_ONCE = 4  # such rows that hold parts
_GLOBAL = 2
_GATHERED = 1 << 20  # words that are counted together
_SHARE = 21  # log2 of the words whose sequences a task adds up
_USUAL = 48  # bytes of a word
_MAP = 26  # log2 of a bitmap's bits, at least
_SIEVE = 27  # log2 of a sieve's bits, at least
_MOST = 30  # log2 of the bits of either, at most
_PIECES = 8  # log2 of the pieces it is put together from
_TOP = 2  # log2 of the parts that values come to the driver in
_STEP = 0xBF58476D1CE4E5BB  # 3 modulo 8, so that words that change places change the hash
_BACK = pow(_STEP, -1, 1 << 64)
#: The smallest threshold of the test, two kinds; a little below, as sums are not exact.
_LOWEST = 2 + 4 * np.sqrt(2 * 2) - 1e-6
_GROWN = "length int, c long, h long, n long, p double, v double, open boolean"
_GROWN_TYPE = pa.schema([
    ("length", pa.int32()), ("c", pa.int64()), ("h", pa.int64()), ("n", pa.int64()),
    ("p", pa.float64()), ("v", pa.float64()), ("open", pa.bool_()),
])
#: One length over all texts, in parts: all its rows (h, v, n) by the highest bits of h, ``valued`` of them with
#: a value; open transitions (h, c, p); open contexts (h, n); sequences (h, n, s) that may be the next contexts, s
#: their forms without the oldest word.
_ROW, _TRANSITION, _CONTEXT, _LONGER = range(4)
_JUDGED = "what int, length int, spot long, valued long, h binary, n binary, v binary, p binary, c binary, s binary"
_JUDGED_TYPE = pa.schema([
    ("what", pa.int32()), ("length", pa.int32()), ("spot", pa.int64()), ("valued", pa.int64()),
    *[(name, pa.binary()) for name in "hnvpcs"],
])
_MODEL = {"h": np.int64, "v": np.float64, "n": np.int64}


def given_back() -> None:
    """To the system, what is free: workers go on to other tasks, two beside an executor's JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def of_parts(run):
    """A function for mapInArrow whose tasks leave no free memory held."""

    def one(parts):
        try:
            yield from run(parts)
        finally:
            given_back()

    return one


def of_group(run):
    """of_parts() for applyInArrow."""

    def one(part):
        try:
            return run(part)
        finally:
            given_back()

    return one


def of_groups(run):
    """of_parts() for applyInArrow on two frames."""

    def one(left, right):
        try:
            return run(left, right)
        finally:
            given_back()

    return one


def spelled(bodies: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of binary texts in lower case, all words as their numbers, each text's first place."""
    texts = pc.ascii_lower(pc.fill_null(bodies, b"").view(pa.string()))
    lists = pc.ascii_split_whitespace(texts)
    found = lists.flatten().dictionary_encode()
    kinds, codes = found.dictionary.view(pa.binary()), found.indices.to_numpy()
    # Breaks at either end of a text leave an empty word there.
    real = codes != pc.index(kinds, b"").as_py()
    starts = np.append(0, np.cumsum(real))[lists.offsets.to_numpy()[:-1]]
    return kinds, codes[real], starts


# --- word sequences ----------------------------------------------------------------------


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of binary words, those of usual length eight bytes at a time for all together."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    starts, sizes = ends[:-1], np.diff(ends)
    data = np.frombuffer(data or b"", np.uint8)
    found = mixed(sizes.astype(np.uint64) + np.uint64(BEGIN))
    at = np.flatnonzero(sizes <= _USUAL)
    for j in range(0, _USUAL, 8):
        at = at[sizes[at] > j]
        if not len(at):
            break
        spots = np.arange(j, j + 8)
        eight = data[np.minimum(starts[at][:, None] + spots, len(data) - 1)]
        eight[spots >= sizes[at][:, None]] = 0
        found[at] = mixed(found[at] * np.uint64(_STEP) ^ eight.view(np.uint64)[:, 0])
    for i in np.flatnonzero(sizes > _USUAL).tolist():
        found[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i + 1]].tobytes())
    return mixed(found)


def mixed(found: np.ndarray) -> np.ndarray:
    found = found ^ (found >> np.uint64(29))
    found = found * np.uint64(0x94D049BB133111EB)
    return found ^ (found >> np.uint64(32))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first powers, at least n, of the step and of its inverse."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_STEP, _BACK)):
            steps = np.full(n + (1 << 18), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


class Places:
    """Words of texts, each after a beginning and before an end, and hashes of what ends where."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, kinds=None, codes=None):
        self.words, self.starts = words, starts
        self.kinds, self.codes = kinds, codes  # distinct words, and all as their numbers, where they are known
        sizes = np.diff(np.append(starts, len(words)))
        self.before = np.arange(len(words)) - np.repeat(starts, sizes)  # words in front, in the text
        self.up, down = powers(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * down[: len(words)], out=self.sums[1:])

    def raw(self, ends: np.ndarray, length) -> np.ndarray:
        return (self.sums[ends + 1] - self.sums[ends + 1 - length]) * self.up[ends]

    def hashes(self, ends: np.ndarray, length) -> np.ndarray:
        """Of the sequences of so many words that end there, within their texts."""
        return mixed(self.raw(ends, length))

    def followed(self, length: int, known: np.ndarray, width: int) -> np.ndarray:
        """Where a context of ``length`` words has ended whose last ``width`` may be known."""
        ends = np.flatnonzero(self.before >= length)
        if width == 1 and self.codes is not None:
            return ends[may(known, mixed(self.kinds))[self.codes[ends - 1]]]
        return ends[may(known, self.hashes(ends - 1, width))]


def numbered(bodies: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """spelled() with an end after each text, the last of the words, and a beginning, numbered after it."""
    kinds, codes, starts = spelled(bodies)
    kinds = pa.concat_arrays([kinds, pa.array([END], pa.binary())])
    texts = np.arange(len(starts))
    sizes = np.diff(np.append(starts, len(codes)))
    out = np.full(len(codes) + 2 * len(starts), len(kinds) - 1, np.int32)
    out[np.arange(len(codes)) + np.repeat(2 * texts + 1, sizes)] = codes
    starts = starts + 2 * texts
    out[starts] = len(kinds)
    return kinds, out, starts


def hashes_of(kinds: pa.Array) -> np.ndarray:
    """Hashes by the numbers of numbered()."""
    return np.append(word_hashes(kinds), np.uint64(BEGIN))


def _encoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block of texts: hashes of distinct words, words as their numbers, beginnings."""
    for part in parts:
        kinds, codes, starts = numbered(part.column(0))
        yield _row(hashes_of(kinds), codes, starts)


def _block(words: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    first, codes = ranked(words)
    return _row(words[first], codes, starts)


def _row(kinds: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    blobs = (kinds, codes.astype(_width(kinds)), starts)
    return rows(("kinds", "codes", "starts"), *[[b.tobytes()] for b in blobs])


def _width(kinds: np.ndarray) -> type:
    """Of numbers of so many kinds."""
    return np.uint16 if len(kinds) <= 1 << 16 else np.uint32


def _remaining(length: int, known):
    """Blocks of the texts that still have one of the contexts, with a word in front."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, starts, size = [], [], 0
        for block in _blocks(parts):
            ends = block.followed(length + 1, known.value, length)
            limits = np.append(block.starts, len(block.words))
            wanted = np.zeros(len(block.words), bool)
            wanted[ends] = True
            for text in np.flatnonzero(np.logical_or.reduceat(wanted, block.starts)).tolist():
                words.append(block.words[limits[text] : limits[text + 1]])
                starts.append(size)
                size += len(words[-1])
            if size > FLUSH:
                yield _block(np.concatenate(words), np.array(starts, np.int64))
                words, starts, size = [], [], 0
        if size:
            yield _block(np.concatenate(words), np.array(starts, np.int64))

    return of_parts(run)


def _block_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for part in parts:
        for i in range(part.num_rows):  # one at a time, as a batch holds many
            kinds, codes, starts = (column[i].as_buffer() for column in part.columns)
            kinds = np.frombuffer(kinds, np.uint64)
            yield kinds, np.frombuffer(codes, _width(kinds)), np.frombuffer(starts, np.int64)


def _blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[Places]:
    for kinds, codes, starts in _block_rows(parts):
        yield Places(kinds[codes], starts)


def _gathered(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, Places]]:
    """Many blocks as one: distinct words, words as their numbers, places."""

    def one(held: list) -> tuple[np.ndarray, np.ndarray, Places]:
        kinds = np.concatenate([k for k, _, _ in held])
        first, numbers = ranked(kinds)
        kinds, numbers = kinds[first], numbers.astype(np.int32)
        codes, starts, at, size = [], [], 0, 0
        for own, of, begin in held:
            codes.append(numbers[at : at + len(own)][of])
            starts.append(begin + size)
            at += len(own)
            size += len(of)
        codes = np.concatenate(codes)
        return kinds, codes, Places(kinds[codes], np.concatenate(starts), kinds, codes)

    held, size = [], 0
    for block in _block_rows(parts):
        held.append(block)
        size += len(block[1])
        if size > _GATHERED:
            yield one(held)
            held, size = [], 0
    if held:
        yield one(held)


def _first(keys: np.ndarray) -> np.ndarray:
    """Where each of the keys, of which equal ones stand together, begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of keys, where in that order each different one begins, and how often it occurs."""
    order = np.argsort(keys)
    new = _first(keys[order])
    return order, new, np.diff(np.append(new, len(keys)))


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different key, ascending, and each key's number among these."""
    order, new, times = distinct(keys)
    numbers = np.empty(len(keys), np.int64)
    numbers[order] = np.repeat(np.arange(len(new)), times)
    return order[new], numbers


def placed(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of the wanted is among the ascending keys, and whether it is."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    order = np.argsort(wanted)
    at = np.empty(len(wanted), np.int64)
    at[order] = np.minimum(np.searchsorted(keys, wanted[order]), len(keys) - 1)
    return at, keys[at] == wanted


def rows(names: tuple[str, ...], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list(names))


def stored(df: DataFrame, purpose: str, used: list[str] | None = None) -> DataFrame:
    """The frame as a written table; its folder joins those to remove once they are used."""
    spark: SparkSession = df.sparkSession
    folder = work_folder(spark, purpose)
    # Rows that hold parts are large: pages end by their size, not after a hundred rows.
    df.write.option("parquet.page.size.row.check.min", "1").parquet(folder)
    if used is not None:
        used.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def swept(spark: SparkSession):
    """What is shuffled inside is removed with the query that shuffled it; no frame may run twice there."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Values:
    """Values of hashes, found by the highest bits behind the first ``top``, which are the same in all."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        order = np.argsort(hashes)
        self.__setstate__((np.append(hashes[order], ~np.uint64(0)), np.append(values[order], 0.0), 0))

    @classmethod
    def ordered(cls, hashes: np.ndarray, values: np.ndarray, top: int = 0) -> "Values":
        """Of ascending hashes, and one more that no search passes; the arrays are kept, not copied."""
        made = cls.__new__(cls)
        made.__setstate__((hashes, values, top))
        return made

    def __getstate__(self) -> tuple:
        return self.hashes, self.values, self.top

    def __setstate__(self, state: tuple) -> None:
        self.hashes, self.values, self.top = state[0], state[1], state[2]
        bits = max(len(self).bit_length(), 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.empty(1 << bits, np.int32)
        lowest = self.hashes[0] >> np.uint64(64 - self.top) << np.uint64(64 - self.top) if self.top else np.uint64(0)
        for at in range(0, 1 << bits, SENT):
            heads = np.arange(at, min(at + SENT, 1 << bits), dtype=np.uint64) << self.shift >> np.uint64(self.top)
            self.first[at : at + SENT] = np.searchsorted(self.hashes[:-1], heads + lowest)

    def __len__(self) -> int:
        return len(self.hashes) - 1

    def places(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash is among the values, and whether it is."""
        at = self.first[wanted << np.uint64(self.top) >> self.shift]
        lower = np.flatnonzero(self.hashes[at] < wanted)
        while len(lower):
            at[lower] += 1
            lower = lower[self.hashes[at[lower]] < wanted[lower]]
        return at, (self.hashes[at] == wanted) & (at < len(self))


def looked_up(near: list, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the hashes, and which have one; ``near`` has Values by the first bits, or None."""
    values, hit = np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    of = wanted >> np.uint64(64 - _TOP)
    for i, part in enumerate(near):
        if part is not None:
            mine = np.flatnonzero(of == i)
            at, some = part.places(wanted[mine])
            values[mine[some]] = part.values[at[some]]
            hit[mine[some]] = True
    return values, hit


# --- the model: values of sequences in parts by their hashes --------------------------------

def _modelled(part: pa.Table) -> pa.Table:
    h, v, n = read(part, "h", np.uint64), read(part, "v", np.float64), read(part, "n", np.int64)
    order, new, _ = distinct(h)
    columns = h[order[new]], np.add.reduceat(v[order], new), np.maximum.reduceat(n[order], new)
    return pa.table({"spot": [part["spot"][0].as_py()], **{k: [c.tobytes()] for k, c in zip("hvn", columns)}})


def modelled(tree: DataFrame) -> DataFrame:
    """Parts (spot, h, v, n) by the highest bits of the hashes, ascending, from such that may share hashes.

    A sequence may be a context and another one's transition: n is the greater number, v the sum. Those
    without a value have n 0.
    """
    return stored(tree.groupBy("spot").applyInArrow(of_group(_modelled), _named(_MODEL)), "model")


def _bins(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(n, 1)) * 16).astype(np.int64)


def _binned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        n = values_in(part.column(0), np.int64)
        found, of, size = np.unique(np.where(n > 0, _bins(n), -1), return_inverse=True, return_counts=True)
        sums = np.zeros(len(found), np.int64)
        np.add.at(sums, of, n)
        yield rows(("bin", "rows", "sum"), found, size, sums)


def numbers_of(parts: DataFrame, name: str = "n") -> list:
    """How many numbers there are in parts, by bins (bin, rows, sum) of their size, -1 for zeros."""
    found = parts.select(name).mapInArrow(_binned, "bin long, rows long, sum long")
    return found.groupBy("bin").agg(F.sum("rows").alias("rows"), F.sum("sum").alias("sum")).collect()


def valued(model: DataFrame, below: int | None = None, since: int | None = None) -> DataFrame:
    """Parts (spot, h, v) of the sequences with a value, of bins below one or from one on."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for spot, *blobs in zip(*part.columns):
                h, v, n = (np.frombuffer(b.as_buffer(), k) for b, k in zip(blobs, _MODEL.values()))
                some = (n > 0) & within(n, below, since)
                yield rows(("spot", "h", "v"), [spot.as_py()], [h[some].tobytes()], [v[some].tobytes()])

    return model.select("spot", *_MODEL).mapInArrow(run, _named(("h", "v")))


def within(n: np.ndarray, below: int | None, since: int | None) -> np.ndarray:
    """Which numbers are in bins below one and from one on."""
    some = np.ones(len(n), bool)
    if below is not None:
        some &= _bins(n) < below
    if since is not None:
        some &= _bins(n) >= since
    return some


def fetched(model: DataFrame, log_spots: int, since: int) -> Iterator[Values | None]:
    """The values from one bin on by the first bits of their hashes; the driver holds one of these at a time."""
    step = 1 << log_spots - _TOP
    for first in range(0, 1 << log_spots, step):
        found = valued(model.filter(F.col("spot").between(first, first + step - 1)), since=since).toArrow()
        order = pc.sort_indices(found["spot"]).to_pylist()
        hashes = [np.frombuffer(found["h"][i].as_buffer(), np.uint64) for i in order]
        values = [np.frombuffer(found["v"][i].as_buffer(), np.float64) for i in order]
        if not sum(map(len, hashes)):
            yield None
            continue
        yield Values.ordered(
            np.concatenate([*hashes, [~np.uint64(0)]], dtype=np.uint64), np.concatenate([*values, [0.0]]), _TOP
        )


# --- bitmaps -----------------------------------------------------------------------------


def _log_bits(rows: int, share: int, least: int) -> int:
    """log2 of the bits for so many rows, ``share`` bits for each."""
    return min(max((share * rows).bit_length(), least), _MOST)


def _size(known: DataFrame, size: int | None) -> int:
    if size is not None:
        return size
    if known.schema["h"].dataType.typeName() == "binary":
        return (known.agg(F.sum(F.octet_length("h"))).first()[0] or 0) // 8
    return known.count()


def values_in(column: pa.Array, kind: type) -> np.ndarray:
    """The numbers of a column of them, or of parts of it as bytes."""
    if pa.types.is_binary(column.type):
        return np.concatenate([np.zeros(0, kind), *[np.frombuffer(b.as_buffer(), kind) for b in column]])
    return column.to_numpy(zero_copy_only=False).view(kind)


def _spots(bits_of: Callable, log_bits: int, below: int | None):
    """The bits of hashes by their highest bits, each once."""

    def out(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        bits = np.sort(np.concatenate(held))
        bits = bits[_first(bits)]
        of = bits >> np.uint32(log_bits - _PIECES)
        cuts = _first(of)
        ends = np.append(cuts[1:], len(of))
        yield rows(("spot", "bits"), of[cuts].astype(np.int64), [bits[a:b].tobytes() for a, b in zip(cuts, ends)])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in parts:
            hashes = values_in(part.column(0), np.uint64)
            if below is not None:
                n = values_in(part.column(1), np.int64)
                hashes = hashes[(n > 0) & within(n, below, None)]
            bits = [b.astype(np.uint32) for b in bits_of(hashes, log_bits)]
            held += bits
            size += sum(map(len, bits))
            if size > 2 * _ROWS:
                yield from out(held)
                held, size = [], 0
        if size:
            yield from out(held)

    return of_parts(run)


def _set(log_bits: int):
    def run(part: pa.Table) -> pa.Table:
        spot, one = part["spot"][0].as_py(), np.zeros(1 << log_bits - _PIECES, np.uint8)
        for bits in part["bits"]:
            one[np.frombuffer(bits.as_buffer(), np.uint32) & np.uint32((1 << log_bits - _PIECES) - 1)] = 1
        return pa.table({"spot": [spot], "bits": [np.packbits(one, bitorder="little").tobytes()]})

    return of_group(run)


def _together(known: DataFrame, bits_of: Callable, log_bits: int, below: int | None = None) -> np.ndarray:
    """Bytes with the bits of the hashes in column h set, put together by tasks."""
    found = (
        (known.select("h") if below is None else known.select("h", "n"))
        .mapInArrow(_spots(bits_of, log_bits, below), "spot long, bits binary")
        .groupBy("spot")
        .applyInArrow(_set(log_bits), "spot long, bits binary")
        .toArrow()
    )
    size = 1 << log_bits - 3 - _PIECES
    bits = np.zeros(1 << log_bits - 3, np.uint8)
    for spot, part in zip(found["spot"].to_pylist(), found["bits"]):
        bits[spot * size : (spot + 1) * size] = np.frombuffer(part.as_buffer(), np.uint8)
    return bits


def _bit_of(hashes: np.ndarray, log_bits: int) -> tuple[np.ndarray, ...]:
    return (hashes >> np.uint64(64 - log_bits),)


def _bits_of(hashes: np.ndarray, log_bits: int) -> tuple[np.ndarray, ...]:
    return hashes & np.uint64((1 << log_bits) - 1), hashes >> np.uint64(64 - log_bits)


def bitmap(known: DataFrame, size: int | None = None) -> np.ndarray:
    """Bits, of which those of the hashes in column h are set; ``size`` is how many there are."""
    return _together(known, _bit_of, _log_bits(_size(known, size), 4, _MAP)).view(np.uint64)


def may(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    shift = 64 - (len(bits).bit_length() - 1)
    spots = bits[hashes >> np.uint64(shift)]
    return (spots >> ((hashes >> np.uint64(shift - 6)) & np.uint64(63))) & np.uint64(1) != 0


def sieve(known: DataFrame, size: int | None = None, below: int | None = None) -> np.ndarray:
    """Bytes with two bits set for each hash in column h; of a model's parts only those of bins below one."""
    return _together(known, _bits_of, _log_bits(_size(known, size), 8, _SIEVE), below)


def passed(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have both bits set."""
    found = _bits_of(hashes, len(bits).bit_length() + 2)
    one, other = (bits[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8) for b in found)
    return one & other & np.uint8(1) != 0


def _marks(wanted: Callable[[Places], np.ndarray], least: int, log_groups: int):
    """High halves of the wanted hashes, sorted, with their numbers, by their highest bits."""
    kind = np.uint8 if least < 256 else np.uint32

    def out(high: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        of = high >> np.uint32(32 - log_groups)
        cuts = _first(of)
        ends = np.append(cuts[1:], len(of))
        yield rows(
            ("spot", "high", "n"), of[cuts].astype(np.int64),
            [high[a:b].tobytes() for a, b in zip(cuts, ends)],
            [n[a:b].astype(kind).tobytes() for a, b in zip(cuts, ends)],
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for block in _blocks(parts):
            held.append((wanted(block) >> np.uint64(32)).astype(np.uint32))
            size += len(held[-1])
            if size > _ROWS:
                high, n = np.unique(np.concatenate(held), return_counts=True)
                yield from out(high, np.minimum(n, least))
                held, size = [], 0
        if size:
            high, n = np.unique(np.concatenate(held), return_counts=True)
            yield from out(high, np.minimum(n, least))

    return of_parts(run)


def _marked(least: int, log_groups: int):
    kind = np.uint8 if least < 256 else np.uint32

    def run(part: pa.Table) -> pa.Table:
        high = np.concatenate([np.frombuffer(b, np.uint32) for b in part["high"].to_pylist()])
        n = np.concatenate([np.frombuffer(b, kind) for b in part["n"].to_pylist()])
        order = np.argsort(high)
        high, n = high[order], n[order].astype(np.int64)
        new = np.flatnonzero(np.append(True, high[1:] != high[:-1]))
        often = high[new][np.add.reduceat(n, new) >= least]
        spot = part["spot"][0].as_py()
        bits = np.zeros(1 << _MAP - log_groups, np.uint8)
        bits[(often >> np.uint32(32 - _MAP)).astype(np.int64) - (spot << _MAP - log_groups)] = 1
        return pa.table({"spot": [spot], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    return of_group(run)


def frequent(blocks: DataFrame, wanted, least: int, places: int) -> np.ndarray:
    """A bitmap of the wanted hashes that may occur ``least`` times, from counts of their halves."""
    log_groups = min(max(places >> 21, 8).bit_length(), 20)
    found = (
        blocks.mapInArrow(_marks(wanted, least, log_groups), "spot long, high binary, n binary")
        .groupBy("spot")
        .applyInArrow(_marked(least, log_groups), "spot long, bits binary")
        .toPandas()
    )
    size = 1 << _MAP - 3 - log_groups
    bits = np.zeros(1 << _MAP - 3, np.uint8)
    for spot, part in zip(found["spot"], found["bits"]):
        bits[spot * size : (spot + 1) * size] = np.frombuffer(part, np.uint8)
    return bits.view(np.uint64)


# --- one length over all texts -----------------------------------------------------------


def _spot(hashes: np.ndarray, spots: int) -> np.ndarray:
    """Of so many, by the highest bits: ascending with the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(spots) >> np.uint64(32)).astype(np.int64)


def _raw(table: np.ndarray) -> np.ndarray:
    """Places.raw() of sequences in rows, the oldest word first."""
    found = table[:, 0].copy()
    for j in range(1, table.shape[1]):
        found = found * np.uint64(_STEP) + table[:, j]
    return found


def dealt(keys: np.ndarray, spots: int, **columns: np.ndarray) -> pa.Table:
    """A row for each spot of the keys: the columns' values there, in the order of the keys, as bytes."""
    order = np.argsort(keys)
    of = _spot(keys[order], spots)
    cuts = _first(of)
    ends = np.append(cuts[1:], len(of))
    found = {"spot": pa.array(of[cuts], pa.int64())}
    for name, column in columns.items():
        column = column[order]
        found[name] = pa.array([column[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())
    return pa.table(found)


def read(part: pa.Table, name: str, kind: type) -> np.ndarray:
    """A column of dealt() from all rows of a group."""
    found = [np.frombuffer(b.as_buffer(), kind) for b in part[name]]
    return np.concatenate(found) if found else np.zeros(0, kind)


def parted(spots: int, kinds: dict[str, type]):
    """Rows, or parts of them, by the hash in their first column as rows of dealt()."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            columns = dict(zip(kinds, (np.concatenate(c) for c in zip(*held))))
            yield from dealt(columns["h"].view(np.uint64), spots, **columns).to_batches(_AT_ONCE)

        for part in parts:
            held.append([values_in(c, kind) for c, kind in zip(part.columns, kinds.values())])
            size += len(held[-1][0])
            if size > 2 * _ROWS:
                yield from out()
                held, size = [], 0
        if size:
            yield from out()

    return of_parts(run)


def _named(kinds) -> str:
    return "spot long, " + ", ".join(f"{name} binary" for name in kinds)


def as_rows(df: DataFrame, kinds: dict[str, type]) -> DataFrame:
    """The rows of which the columns hold parts."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = [values_in(c, kind) for c, kind in zip(part.columns, kinds.values())]
            for at in range(0, len(columns[0]), SENT):
                yield rows(tuple(kinds), *[c[at : at + SENT] for c in columns])

    types = ", ".join(f"{name} {'long' if kind is np.int64 else 'double'}" for name, kind in kinds.items())
    return df.select(*kinds).mapInArrow(run, types)


def in_parts(df: DataFrame, spots: int, kinds: dict[str, type]) -> DataFrame:
    """The rows, a hash h and other numbers, in parts by the hash."""
    return df.mapInArrow(parted(spots, kinds), _named(kinds))


def _sequences(length: int, known, spots: int):
    """Contexts of ``length`` words, each with the next one, and how often they occur, by their hashes.

    The words of such a row are numbers of distinct ones.
    """

    def out(kinds: np.ndarray, of: np.ndarray, table: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = _first(of)
        ends = np.append(cuts[1:], len(of))
        seen, numbers = np.zeros(len(kinds), bool), np.zeros(len(kinds), np.int32)
        for at in range(0, len(cuts), _AT_ONCE):
            blobs = []
            for a, b in zip(cuts[at : at + _AT_ONCE].tolist(), ends[at : at + _AT_ONCE].tolist()):
                mine = table[a:b]
                if mine.size < len(kinds) >> 6:
                    some = np.unique(mine)
                else:
                    seen[mine] = True
                    some = np.flatnonzero(seen)
                    seen[some] = False
                numbers[some] = np.arange(len(some))
                blobs.append((kinds[some].tobytes(), numbers[mine].astype(_width(some)).tobytes(), n[a:b].tobytes()))
            yield rows(("spot", "kinds", "codes", "n"), of[cuts[at : at + _AT_ONCE]], *map(list, zip(*blobs)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kinds, codes, block in _gathered(parts):
            ends = block.followed(length, known.value, length)
            found = block.hashes(ends, length + 1)
            order, new, n = distinct(found)
            first = order[new]
            of, first = _spot(found[first], spots), ends[first]
            del block, found, order, ends
            yield from out(kinds, of, codes[first[:, None] + np.arange(-length, 1)], n.astype(np.uint32))

    return of_parts(run)


def _added(length: int, entry: int, spots: int):
    """The sequences of a spot that occur ``entry`` times, by the hash of what they are without the oldest word."""

    def run(part: pa.Table) -> pa.Table:
        held = []
        for kinds, codes in zip(part["kinds"], part["codes"]):
            kinds = np.frombuffer(kinds.as_buffer(), np.uint64)
            held.append(kinds[np.frombuffer(codes.as_buffer(), _width(kinds))].reshape(-1, length + 1))
        table, n = np.concatenate(held), read(part, "n", np.uint32)
        order, new, _ = distinct(mixed(_raw(table)))
        n = np.add.reduceat(n[order].astype(np.int64), new)
        stays = n >= entry
        table, n = table[order[new[stays]]], n[stays]
        return dealt(mixed(_raw(table[:, 1:])), spots, words=table, n=n)

    return of_group(run)


def _preceded(length: int, spots: int):
    """The sequences with their probabilities in the next shorter contexts, by the hash of their contexts."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        table, n = read(left, "words", np.uint64).reshape(-1, length + 1), read(left, "n", np.int64)
        known, p = read(right, "h", np.uint64), read(right, "p", np.float64)
        order = np.argsort(known)
        at, hit = placed(known[order], mixed(_raw(table[:, 1:])))
        table, n, p = table[hit], n[hit], p[order[at[hit]]]
        return dealt(mixed(_raw(table[:, :-1])), spots, words=table, n=n, p=p)

    return of_groups(run)


def _judged(length: int, least: int, more: bool, log_parts: int):
    """Tests and smooths contexts with what follows them."""

    def part_of(what: int, spots, valued, **columns: list) -> pa.Table:
        size = len(spots)
        given = {"what": [what] * size, "length": [length] * size, "spot": spots, "valued": valued, **columns}
        return pa.table([pa.array(given.get(f.name, [None] * size), f.type) for f in _JUDGED_TYPE], schema=_JUDGED_TYPE)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        table, n = read(left, "words", np.uint64).reshape(-1, length + 1), read(left, "n", np.int64)
        p = read(left, "p", np.float64)
        known, total = read(right, "h", np.uint64), read(right, "n", np.int64)
        order = np.argsort(known)
        context = _raw(table[:, :-1])
        at, hit = placed(known[order], mixed(context))
        if not hit.any():
            return _JUDGED_TYPE.empty_table()
        table, n, p, context, total = table[hit], n[hit], p[hit], context[hit], total[order[at[hit]]]
        first, of = ranked(context)
        h = mixed(context * np.uint64(_STEP) + table[:, -1])
        found, _ = _tested(
            context[first], total[first].astype(np.float64), h, n.astype(np.float64), of, p, length, least
        )
        v, is_context, is_open = found["v"], found["is_context"], found["open"]
        without = np.isnan(v)
        parts = dealt(
            found["h"].view(np.uint64), 1 << log_parts,
            h=found["h"], v=np.where(without, 0.0, v), n=np.where(without, 0, found["n"]),
        )
        counts = [int(np.count_nonzero(np.frombuffer(b.as_buffer(), np.int64))) for b in parts["n"]]
        out = [part_of(_ROW, parts["spot"].to_pylist(), counts, **{k: parts[k].to_pylist() for k in "hvn"})]

        def add(what: int, some: np.ndarray, **columns: np.ndarray) -> None:
            if some.any():
                out.append(part_of(what, [0], [0], **{k: [c[some].tobytes()] for k, c in columns.items()}))

        add(_TRANSITION, is_open & ~is_context, h=found["h"], c=found["c"], p=found["p"])
        add(_CONTEXT, is_open & is_context, h=found["h"], n=found["n"])
        if more:
            add(_LONGER, n >= least, h=h, n=n, s=mixed(_raw(table[:, 1:])))
        return pa.concat_tables(out)

    return of_groups(run)


def _level(
    blocks: DataFrame, length: int, candidates: DataFrame, above: DataFrame, least: int, entry: int, places: int,
    more: bool, log_parts: int, used: list[str], spent: list[str],
) -> DataFrame:
    """_judged() for the ``candidates`` (h, n), contexts of ``length`` words; ``above`` (h, p) are probabilities
    in the next shorter contexts. Its folder joins ``used``, those of what leads to it join ``spent``.

    Counted by their own hashes, sequences that share a frequent word do not meet in one task; those that are
    often enough then go to their shorter forms, and to their contexts.
    """
    spots = 8 + (places >> _SHARE)
    known = blocks.sparkSession.sparkContext.broadcast(bitmap(candidates))
    counted = (
        blocks.mapInArrow(_sequences(length, known, spots), _named(("kinds", "codes", "n")))
        .groupBy("spot")
        .applyInArrow(_added(length, entry, spots), _named(("words", "n")))
    )
    # On its own, so that what follows does not lie beside what is shuffled here.
    counted = stored(counted, "counted", spent)
    known.destroy()
    prior = in_parts(above, spots, {"h": np.int64, "p": np.float64})
    totals = in_parts(candidates, spots, {"h": np.int64, "n": np.int64})
    preceded = counted.groupBy("spot").cogroup(prior.groupBy("spot")).applyInArrow(
        _preceded(length, spots), _named(("words", "n", "p"))
    )
    judged = preceded.groupBy("spot").cogroup(totals.groupBy("spot")).applyInArrow(
        _judged(length, least, more, log_parts), _JUDGED
    )
    return stored(judged, "tree", used)


# --- one length of contexts that one group cannot hold -----------------------------------


def _transitions(length: int, known, width: int):
    """Counts n of sequences h: a context c of ``length`` words and the next; s lacks the oldest."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, block in _gathered(parts):
            ends = block.followed(length, known.value, width)
            found = block.hashes(ends, length + 1)
            order, new, n = distinct(found)
            ends = ends[order[new]]
            part = found[order[new]], block.hashes(ends - 1, length), block.hashes(ends, length), n
            for at in range(0, len(n), SENT):
                yield rows(("h", "c", "s", "n"), *[c[at : at + SENT].view(np.int64) for c in part])

    return of_parts(run)


def _counted(blocks: DataFrame, length: int, known, width: int) -> DataFrame:
    found = blocks.mapInArrow(_transitions(length, known, width), "h long, c long, s long, n long")
    return found.groupBy("h").agg(F.first("c").alias("c"), F.first("s").alias("s"), F.sum("n").alias("n"))


def _learned(
    length: int, counted: DataFrame, contexts: DataFrame, prior: DataFrame, least: int,
    used: list[str], spent: list[str],
):
    """Test and smooth one length.

    ``counted`` (h, c, s, n) are transitions often enough, ``contexts`` (c, total) the candidates, ``prior``
    (s, prior) the probabilities in the next shorter contexts. The folder of the result joins ``used``, those
    of what leads to it join ``spent``.
    """
    pairs = stored(counted.join(contexts, "c").join(prior, "s"), "transitions", spent)
    share = F.col("n") / F.col("total")
    sums = pairs.groupBy("c").agg(
        F.first("total").alias("size"),
        (F.count("*") + 1.0).alias("kinds"),
        F.sum("n").alias("listed"),
        F.least(F.sum("prior"), F.lit(1 - 1e-9)).alias("expected"),
        F.sum(F.col("n") * F.log(share / F.col("prior"))).alias("apart"),
    )
    size, kinds, expected = F.col("size"), F.col("kinds"), F.col("expected")
    others = F.greatest(size - F.col("listed"), F.lit(0)) / size
    tail = F.when(others > 0, size * others * F.log(others / (1 - expected))).otherwise(0.0)
    left = 1 - (F.col("listed") + kinds * expected) / (size + kinds)
    rest = F.log10(F.greatest(left, F.lit(1e-12)) / (1 - expected))
    retained = 2 * (F.col("apart") + tail) > kinds + 4 * F.sqrt(2 * kinds)
    tested = stored(
        sums.select("c", "size", "kinds", "listed", F.when(retained, rest).alias("rest")), "contexts", spent
    )
    smooth = (F.col("n") + kinds * F.col("prior")) / (F.col("total") + kinds)
    kept = F.col("rest").isNotNull()
    level = stored(
        pairs.join(tested.select("c", "kinds", "rest"), "c").select(
            "h", "c", "s", "n",
            F.when(kept, smooth).otherwise(F.col("prior")).alias("p"),
            F.when(kept, F.log10(smooth / F.col("prior")) - F.col("rest")).alias("v"),
        ),
        "level", spent,
    )

    def worth(n: Column, p: Column) -> Column:
        return F.when(n > 0, F.greatest(n * F.log(F.least(n / least, F.lit(1.0)) / p), F.lit(0.0))).otherwise(0.0)

    reach = level.groupBy("c").agg(
        F.sum(worth(F.col("n"), F.col("p"))).alias("listed_worth"),
        F.least(F.sum("p"), F.lit(1 - 1e-9)).alias("stored"),
    )
    unlisted = F.greatest(size - F.col("listed"), F.lit(0))
    most = 2 * (F.col("listed_worth") + worth(unlisted, 1 - F.col("stored")))
    judged = stored(
        tested.join(reach, "c").select("c", F.col("size").alias("n"), "rest", (most > _LOWEST).alias("open")),
        "judged", spent,
    )
    useful = judged.filter(F.col("open") | F.col("rest").isNotNull())
    at = F.lit(length).alias("length")
    found = level.join(useful.select("c", "open"), "c").select(at, "c", "h", "n", "p", "v", "open").unionByName(
        useful.select(
            at, F.lit(None).cast("long").alias("c"), F.col("c").alias("h"), "n",
            F.lit(None).cast("double").alias("p"), F.col("rest").alias("v"), "open",
        )
    )
    return stored(found, "tree", used)


# --- many lengths among a context's own occurrences --------------------------------------


def _windows(length: int, width: int, known, often, groups: int):
    """By group of contexts: raw hash, next word, number and the ``width`` words in front, 0 for none.

    The numbers of such a table are distinct ones and their places among them.
    """

    def out(key: np.ndarray, table: np.ndarray) -> Iterator[pa.RecordBatch]:
        of = _group(mixed(table[:, 0]), groups)
        order = np.argsort(of, kind="stable")
        of, table = of[order], table[order]
        cuts = _first(of)
        ends = np.append(cuts[1:], len(of))
        for a, b in zip(cuts.tolist(), ends.tolist()):
            own = table[a:b].ravel()
            first, codes = ranked(own)
            codes = codes.astype(_width(first))
            yield rows(("spot", "kinds", "codes"), [int(of[a])], [own[first].tobytes()], [codes.tobytes()])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        most = (16 << 20) // (8 * (width + 3))

        def merged():
            key, table = map(np.concatenate, zip(*held))
            order, new, _ = distinct(key)
            n = np.add.reduceat(table[order, 2], new)
            table = table[order[new]]
            table[:, 2] = n
            return key[order[new]], table

        for block in _blocks(parts):
            ends = block.followed(length + 1, known.value, length)
            if often is not None:
                ends = ends[may(often.value, block.hashes(ends - 1, length + 1))]
            reach = np.minimum(block.before[ends], length + width)
            key = block.hashes(ends, reach + 1)
            order, new, n = distinct(key)
            key, ends, reach = key[order[new]], ends[order[new]], reach[order[new]]
            table = np.zeros((len(ends), width + 3), np.uint64)
            table[:, 0], table[:, 1], table[:, 2] = block.raw(ends - 1, length), block.words[ends], n
            for j in range(width):
                has = np.flatnonzero(reach > length + j)
                table[has, 3 + j] = block.words[ends[has] - length - 1 - j]
            held.append((key, table))
            size += len(key)
            if size > most:
                held = [merged()]
                size = len(held[0][0])
                if size > most // 2:
                    yield from out(*held[0])
                    held, size = [], 0
        if size:
            yield from out(*merged())

    return of_parts(run)


def _group(contexts: np.ndarray, groups: int) -> np.ndarray:
    return ((contexts >> np.uint64(40)) % np.uint64(groups)).astype(np.uint32)


def _of_groups(groups: int):
    """Transitions (c, h, p) by the group of their contexts."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held)]
            of = _group(columns[0].view(np.uint64), groups)
            order = np.argsort(of, kind="stable")
            of, columns = of[order], [c[order] for c in columns]
            cuts = _first(of)
            ends = np.append(cuts[1:], len(of))
            blobs = [[c[a:b].tobytes() for a, b in zip(cuts, ends)] for c in columns]
            yield from pa.Table.from_batches(
                [rows(("spot", "c", "h", "p"), of[cuts].astype(np.int64), *blobs)]
            ).to_batches(1 << 10)

        for part in parts:
            held.append([values_in(c, kind) for c, kind in zip(part.columns, (np.int64, np.int64, np.float64))])
            size += len(held[-1][0])
            if size > 2 * _ROWS:
                yield from out()
                held, size = [], 0
        if size:
            yield from out()

    return of_parts(run)


def _nothing() -> pa.Table:
    return _GROWN_TYPE.empty_table()


def _subtrees(length: int, width: int, least: int, entry: int):
    """Grow the contexts of a group by up to ``width`` words from their windows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _nothing()
        held = []
        for kinds, codes in zip(left["kinds"].to_pylist(), left["codes"].to_pylist()):
            kinds = np.frombuffer(kinds, np.uint64)
            codes = np.frombuffer(codes, _width(kinds))
            held.append(kinds[codes].reshape(-1, width + 3))
        table = np.concatenate(held)
        known_c, known_h, known_p = (read(right, *of) for of in (("c", np.uint64), ("h", np.uint64), ("p", np.float64)))
        order = np.argsort(known_h)
        known_h, known_p = known_h[order], known_p[order]
        table = table[placed(np.sort(known_c), mixed(table[:, 0]))[1]]
        if not len(table):
            return _nothing()
        context, word, times = table[:, 0], table[:, 1], table[:, 2].astype(np.float64)
        h = mixed(context * np.uint64(_STEP) + word)
        at, hit = placed(known_h, h)
        # What is not listed here is rarer in longer contexts and never asked for there.
        p = np.where(hit, known_p[at], np.nan)
        found = []
        for j in range(width):
            older = table[:, 3 + j]
            go = older != 0
            table, context, word, times, p = (x[go] for x in (table, context, word, times, p))
            context = older[go] * powers(length + j + 1)[0][length + j] + context
            _, of = ranked(context)
            go = np.bincount(of, times)[of] >= least
            table, context, word, times, p = (x[go] for x in (table, context, word, times, p))
            if not len(table):
                break
            first, of = ranked(context)
            names, total = context[first], np.bincount(of, times)
            h = mixed(context * np.uint64(_STEP) + word)
            first, place = ranked(h)
            h, n, c, prior = h[first], np.bincount(place, times), of[first], p[first]
            stays = n >= entry
            post = prior.copy()
            level, opens = _tested(names, total, h[stays], n[stays], c[stays], prior[stays], length + j + 1, least)
            post[stays] = level["post"]
            missing = {"c": level["is_context"], "p": level["is_context"], "v": np.isnan(level["v"])}
            columns = [pa.array(level[f.name], f.type, mask=missing.get(f.name)) for f in _GROWN_TYPE]
            found.append(pa.table(columns, schema=_GROWN_TYPE))
            go = opens[of]
            p = post[place][go]
            table, context, word, times = (x[go] for x in (table, context, word, times))
            if not len(table):
                break
        return pa.concat_tables(found) if found else _nothing()

    return of_groups(run)


def _worth(n: np.ndarray, p: np.ndarray, least: int) -> np.ndarray:
    return np.maximum(n * np.log(np.maximum(np.minimum(n / least, 1), 1e-300) / p), 0)


def _tested(names, total, h, n, c, prior, length: int, least: int) -> tuple[dict, np.ndarray]:
    """_learned() for the contexts of a group: columns of rows, v nan where there is none, and which contexts are open."""
    size = len(names)
    listed = np.bincount(c, n, size)
    kinds = np.bincount(c, minlength=size) + 1.0
    expected = np.minimum(np.bincount(c, prior, size), 1 - 1e-9)
    apart = np.bincount(c, n * np.log(n / total[c] / prior), size)
    unlisted = np.maximum(total - listed, 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        tail = np.where(unlisted > 0, unlisted * np.log(unlisted / total / (1 - expected)), 0)
    some = listed > 0
    retained = some & (2 * (apart + tail) > kinds + 4 * np.sqrt(2 * kinds))
    left = 1 - (listed + kinds * expected) / (total + kinds)
    rest = np.log10(np.maximum(left, 1e-12) / (1 - expected))
    smooth = (n + kinds[c] * prior) / (total[c] + kinds[c])
    post = np.where(retained[c], smooth, prior)
    inside = np.minimum(np.bincount(c, post, size), 1 - 1e-9)
    most = 2 * (np.bincount(c, _worth(n, post, least), size) + _worth(unlisted, 1 - inside, least))
    opens = some & (most > _LOWEST)
    v = np.where(retained[c], np.log10(smooth / prior) - rest[c], 0)
    context = mixed(names).view(np.int64)
    useful = np.flatnonzero(opens | retained)
    step = np.flatnonzero((opens | retained)[c])
    a, b = len(step), len(useful)
    none_v = ~np.concatenate((retained[c][step], retained[useful]))
    return {
        "length": np.full(a + b, length, np.int32),
        "c": np.concatenate((context[c][step], np.zeros(b, np.int64))),
        "h": np.concatenate((h.view(np.int64)[step], context[useful])),
        "n": np.concatenate((n[step], total[useful])).astype(np.int64),
        "p": np.concatenate((post[step], np.zeros(b))),
        "v": np.where(none_v, np.nan, np.concatenate((v[step], rest[useful]))),
        "open": np.concatenate((opens[c][step], opens[useful])),
        "is_context": np.arange(a + b) >= a,
        "post": post,
    }, opens


_BASES = "h", "n", "p", "often_h", "often_n"


# --- the whole tree ----------------------------------------------------------------------


def _bases(mass: float, entry: int, least: int):
    """Words (h, c) that occur ``entry`` times, with their base probabilities, and the beginning of a text.

    Beside them those that occur ``least`` times.
    """
    end, begin = (mixed(x) for x in (word_hashes(pa.array([END], pa.binary())), np.array([BEGIN], np.uint64)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for h, n in zip(part.column(0), part.column(1)):
                h, n = np.frombuffer(h.as_buffer(), np.uint64), np.frombuffer(n.as_buffer(), np.int64)
                p, ends = (n + 0.5) / mass, np.flatnonzero(h == end)
                some = n >= entry
                # As often as texts end, and certain.
                h = np.concatenate([h[some], np.repeat(begin, len(ends))])
                n, p = np.concatenate([n[some], n[ends]]), np.concatenate([p[some], np.ones(len(ends))])
                some = n >= least
                yield rows(_BASES, *[[c.tobytes()] for c in (h, n, p, h[some], n[some])])

    return run


def grow(
    bodies: DataFrame, counts: DataFrame, mass: float, depth: int | None, least: int, entry: int, group: int,
    log_parts: int, used: list[str],
) -> tuple[DataFrame, int] | None:
    """The tree in parts for modelled(), and the greatest length of a retained context; None if it has no level.

    A row is a context h of some words that occurs n times, or a transition: a context c and a next word, which
    has probability p in it. v is what the sequence adds to the score of a text it occurs in, null if its context is not
    retained: for a context log10 of what is left to words not stored with it, for a transition what is
    different. Each sequence's form without its oldest word has a row too, or is a word. ``depth`` None grows until
    nothing is open. ``group`` bounds the bytes of one context's windows in one task. The tree's folders join
    ``used``; all other tables are removed as soon as nothing reads them.
    """
    spark = bodies.sparkSession
    if depth is not None and depth < 1:
        return None
    context = spark.sparkContext
    spent: list[str] = []
    encoded: list[str] = []
    blocks = stored(
        bodies.mapInArrow(of_parts(_encoded), "kinds binary, codes binary, starts binary"), "encoded", encoded
    )
    # Whole texts came in small batches, numbers come in large ones.
    batches(spark, 1 << 16, 1 << 20)
    places = int(mass)
    above = counts.select("h", "c").mapInArrow(
        of_parts(_bases(mass, entry, least)), ", ".join(f"{name} binary" for name in _BASES)
    )
    above = stored(above, "words", spent)
    candidates = above.select(F.col("often_h").alias("h"), F.col("often_n").alias("n"))
    levels, length, last = [], 0, _GLOBAL if depth is None else min(depth, _GLOBAL)
    while length < last:
        length += 1
        more = length < last
        judged = _level(
            blocks, length, candidates, above.select("h", "p"), least, entry, places, more, log_parts, used, spent
        )
        levels.append(judged)
        above = judged.filter(F.col("what") == _TRANSITION)
        kept: list[str] = []
        contexts = as_rows(judged.filter(F.col("what") == _CONTEXT), {"h": np.int64, "n": np.int64})
        contexts = stored(contexts, "contexts", kept)
        if more:
            # Shorter forms of candidates are open contexts, so only these are asked for again.
            often = as_rows(judged.filter(F.col("what") == _LONGER), {"h": np.int64, "n": np.int64, "s": np.int64})
            often = often.join(contexts.select(F.col("h").alias("s")), "s", "left_semi")
            candidates = stored(often.select("h", "n"), "candidates", kept)
        _removed(spark, spent)
        spent += kept

    opened = above.select("c", "h", "p")
    grown, width = [], 2
    while depth is None or length < depth:
        width = width if depth is None else min(width, depth - length)
        if grown:
            found = grown[-1].filter((F.col("length") == length) & F.col("open"))
            contexts, opened = found.filter("c IS NULL").select("h", "n"), found.filter("c IS NOT NULL").select("c", "h", "p")
        largest = contexts.agg(F.max("n")).first()[0]
        if not largest:
            break
        while width > 2 and largest * 8 * (width + 3) > group:
            width //= 2
        most = max(group // (8 * (width + 3)), 1)
        size = contexts.agg(
            F.sum(F.when(F.col("n") <= most, F.col("n"))).alias("small"),
            F.count(F.when(F.col("n") > most, 1)).alias("hot"),
        ).first()
        parts = []
        if len(grown) > 1:  # before, nearly all texts have some
            known = context.broadcast(bitmap(contexts.select("h")))
            before, encoded = encoded, []
            blocks = stored(blocks.mapInArrow(_remaining(length, known), blocks.schema), "encoded", encoded)
            known.destroy()
            _removed(spark, before)
        if size.small:
            parts.append(_in_groups(blocks, contexts, opened, length, width, least, entry, most, size, places, used))
        if size.hot:
            hot = contexts.filter(F.col("n") > most).select("h")
            # Transitions of one length over all texts come in parts.
            step = opened if grown else as_rows(opened, {"c": np.int64, "h": np.int64, "p": np.float64})
            step = step.join(hot.select(F.col("h").alias("c")), "c", "left_semi")
            step = step.select("c", "h", "p").unionByName(hot.select(
                F.lit(None).cast("long").alias("c"), "h", F.lit(None).cast("double").alias("p")
            ))
            for longer in range(length + 1, length + width + 1):
                step = _by_step(blocks, step, longer, least, entry, used)
                parts.append(step)
                step = step.filter("open")
                if step.isEmpty():
                    break
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        grown.append(every)
        length += width
        width = 4 * width if width < 8 else 2 * width

    _removed(spark, encoded + spent)
    tree, longest = None, 0
    for judged in levels:
        found = judged.filter(F.col("what") == _ROW).select("spot", *_MODEL, "valued", "length")
        longest = found.filter("valued > 0").agg(F.max("length")).first()[0] or longest
        found = found.select("spot", *_MODEL)
        tree = found if tree is None else tree.unionByName(found)
    if grown:
        every = grown[0]
        for found in grown[1:]:
            every = every.unionByName(found)
        longest = every.filter("v IS NOT NULL").agg(F.max("length")).first()[0] or longest
        with_value = F.col("v").isNotNull()
        every = every.select(
            "h", F.coalesce("v", F.lit(0.0)).alias("v"), F.when(with_value, F.col("n")).otherwise(0).alias("n")
        )
        tree = tree.unionByName(in_parts(every, 1 << log_parts, _MODEL))
    return tree, longest


def _removed(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        remove_folder(spark, folder)
    folders.clear()


class _Longer:
    """Hashes of the contexts one word longer than those that may be known."""

    def __init__(self, length: int, known):
        self.length, self.known = length, known

    def __call__(self, block: Places) -> np.ndarray:
        ends = block.followed(self.length + 1, self.known.value, self.length)
        return block.hashes(ends - 1, self.length + 1)


def _in_groups(blocks, contexts, opened, length, width, least, entry, most, size, places, used) -> DataFrame:
    context, total = blocks.sparkSession.sparkContext, size.small
    small = contexts.filter(F.col("n") <= most).select("h")
    known = context.broadcast(bitmap(small))
    often = None
    if length == _GLOBAL:  # most of what is open here has no longer form that is a candidate
        often = context.broadcast(frequent(blocks, _Longer(length, known), least, min(places, 2 * total)))
    groups = 8 + total // max(min(most, 200_000), 1000)
    windows = blocks.mapInArrow(
        _windows(length, width, known, often, groups), "spot long, kinds binary, codes binary"
    )
    # Those of larger contexts find no windows here.
    info = opened.mapInArrow(_of_groups(groups), _named(("c", "h", "p")))
    grown = (
        windows.groupBy("spot")
        .cogroup(info.groupBy("spot"))
        .applyInArrow(_subtrees(length, width, least, entry), _GROWN)
    )
    grown = stored(grown, "tree", used)
    known.destroy()
    if often is not None:
        often.destroy()
    return grown


def _by_step(blocks, step, length, least, entry, used) -> DataFrame:
    """The open contexts in ``step``, one word longer."""
    known = blocks.sparkSession.sparkContext.broadcast(bitmap(step.filter("c IS NULL").select("h")))
    spent: list[str] = []
    counted = stored(_counted(blocks, length, known, length - 1), "counted", spent)
    totals = counted.groupBy("c").agg(F.sum("n").alias("total")).filter(F.col("total") >= least)
    prior = step.filter("c IS NOT NULL").select(F.col("h").alias("s"), F.col("p").alias("prior"))
    found = _learned(length, counted.filter(F.col("n") >= entry), totals, prior, least, used, spent)
    known.destroy()
    _removed(blocks.sparkSession, spent)
    return found
