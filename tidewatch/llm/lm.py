"""Language-model scores from a probabilistic suffix tree over words.

Token counts give every word its base probability. The tree refines it: its states are contexts
of preceding words, candidates if they occur ``least`` times in the training
texts, retained if the words that follow differ from those after the next shorter context (a
likelihood-ratio test). It grows until no longer context can be retained (see ``suffix_tree``) or
to ``depth`` words. With ``depth`` None nothing else ends it; a text of one word repeated n times then
takes work that grows with n squared. Words that follow a context ``entry`` times are stored with it, all
others share what is left in proportion to the shorter context (Witten-Bell), so distributions
sum to one. A word is scored in the longest retained context its predecessors end with.

Both bars are absolute, so the tree grows with the corpus. The score of a text is the sum of its words'
base probabilities and of one value for each of its word sequences the model knows. The
``common`` most frequent words and ``cached`` most frequent sequences are looked up in memory. The others are
asked for, words like sequences by a 64-bit hash: texts' hashes and the model's meet in parts by their highest bits,
sorted numbers as bytes, not a row each. Bitmaps that grow with the model tell which sequences may be
known; where they fill up, at 2^30 bits, more is asked for and not found.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import remove_folder
from .common import batches
from .suffix_tree import (
    END,
    FLUSH,
    SENT,
    Places,
    Values,
    bitmap,
    dealt,
    distinct,
    fetched,
    given_back,
    grow,
    hashes_of,
    looked_up,
    may,
    mixed,
    modelled,
    numbered,
    numbers_of,
    of_group,
    of_groups,
    of_parts,
    passed,
    read,
    rows,
    sieve,
    stored,
    swept,
    valued,
    values_in,
    within,
    word_hashes,
)

_OTHER = 0


def held_out(key: Column, of: int, remainder: int) -> Column:
    """Whether the key's checksum falls on the fold; a null key counts as an empty one."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(text) % of == remainder


# --- token counts ----------------------------------------------------------------------


_TOKENS = "spot long, h binary, c binary, ends binary, words binary"
_TOKEN_SPOTS = 64


def _merged(h: np.ndarray, c: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    order, new, _ = distinct(h)
    return h[order[new]], np.add.reduceat(c[order], new), words.take(pa.array(order[new]))


def _in_spots(h: np.ndarray, c: np.ndarray, words: pa.Array) -> pa.Table:
    """By ascending hashes: a row for each spot."""
    parts = dealt(h, _TOKEN_SPOTS, h=h, c=c)
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1]
    size = [len(b.as_buffer()) // 8 for b in parts["h"]]
    cuts = np.append(0, np.cumsum(size)).tolist()
    data = data or pa.py_buffer(b"")
    own = [(ends[a + 1 : b + 1] - ends[a]).tobytes() for a, b in zip(cuts, cuts[1:])]
    spelt = [data.slice(ends[a], ends[b] - ends[a]).to_pybytes() for a, b in zip(cuts, cuts[1:])]
    parts = parts.append_column("ends", pa.array(own, pa.binary()))
    return parts.append_column("words", pa.array(spelt, pa.binary()))


def _words_in(part) -> pa.Array:
    """The words of all rows of _in_spots()."""
    found = [pa.array([], pa.binary())]
    for ends, data in zip(part["ends"], part["words"]):
        ends = np.append(np.int32(0), np.frombuffer(ends.as_buffer(), np.int32))
        found.append(pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), data.as_buffer()]))
    return pa.concat_arrays(found)


def _counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def merged() -> tuple:
        h, c, words = zip(*held)
        return _merged(np.concatenate(h), np.concatenate(c), pa.concat_arrays(words))

    size = 0
    for part in parts:
        kinds, codes, _ = numbered(part.column(0))
        c = np.bincount(codes, minlength=len(kinds) + 1)[:-1]
        # The end of a text is the last one.
        held.append((mixed(word_hashes(kinds)), c, kinds))
        size += len(kinds)
        if size > 2 * FLUSH:
            held = [merged()]
            size = len(held[0][0])
            if size > FLUSH:
                yield from _in_spots(*held[0]).to_batches(4)
                held, size = [], 0
    if size:
        yield from _in_spots(*merged()).to_batches(4)


def _totals(part: pa.Table) -> pa.Table:
    h, c = read(part, "h", np.uint64), read(part, "c", np.int64)
    return _in_spots(*_merged(h, c, _words_in(part)))


def token_parts(docs: DataFrame, text: str = "text") -> DataFrame:
    """token_counts() in parts by the hashes h of the words, ascending."""
    bodies = docs.select(F.col(f"`{text}`").cast("binary"))
    return bodies.mapInArrow(of_parts(_counted), _TOKENS).groupBy("spot").applyInArrow(of_group(_totals), _TOKENS)


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) of all texts: lower-case words, and the end of each text."""

    def spelt(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words, c = _words_in(part), values_in(part["c"], np.int64)
            for at in range(0, len(c), SENT):
                yield rows(("word", "c"), words[at : at + SENT], c[at : at + SENT])

    return token_parts(docs, text).select("c", "ends", "words").mapInArrow(spelt, "word binary, c long")


# --- suffix tree in memory: the plain form of the tables below -------------------------


@dataclass
class Level:
    """Contexts of one length: symbol tuples, oldest first, and what follows them."""

    contexts: list[tuple[int, ...]]
    keys: np.ndarray  # oldest symbol * contexts of the level above + context without it
    codes: np.ndarray  # context * symbols + next symbol, sorted
    gain: np.ndarray  # log10 of the transition's probability over the symbol's base
    rest: np.ndarray  # for each context, what is added to the shorter one's gain otherwise


@dataclass
class Tree:
    ids: dict[bytes, int]  # symbols from 1; the last id is the beginning of a text
    base: np.ndarray  # base probability of each symbol
    levels: list[Level] = field(default_factory=list)

    @property
    def size(self) -> int:
        return len(self.base)

    @property
    def begin(self) -> int:
        return self.size - 1

    def flat(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, each after a beginning and before an end; where each begins."""
        ids, out, starts = self.ids, [], []
        for words in texts:
            starts.append(len(out))
            out.append(self.begin)
            out += [ids.get(w, _OTHER) for w in words]
            out.append(ids.get(END, _OTHER))
        return np.array(out, np.int64), np.array(starts, np.int64)

    def contexts(self, symbols: np.ndarray) -> Iterator[np.ndarray]:
        """For each level: the context each position stands in, -1 if none."""
        inner = np.full(len(symbols), 0)
        reach = symbols != self.begin  # positions that are predicted
        above = 1
        for d, level in enumerate(self.levels, 1):
            old = np.concatenate((np.full(d, _OTHER), symbols[:-d]))[: len(symbols)]
            key = old * above + inner
            at = np.minimum(np.searchsorted(level.keys, key), max(len(level.keys) - 1, 0))
            hit = reach & (level.keys[at] == key) if len(level.keys) else np.zeros(len(key), bool)
            inner = np.where(hit, at, -1)
            yield inner
            reach = hit & (old != self.begin)
            inner, above = np.maximum(inner, 0), len(level.keys)

    def gains(self, symbols: np.ndarray) -> np.ndarray:
        """log10 of each position's symbol probability over its base; 0 at beginnings."""
        gain = np.zeros(len(symbols))
        for level, context in zip(self.levels, self.contexts(symbols)):
            at = np.flatnonzero(context >= 0)
            gain[at] = self.step(level, context[at], symbols[at], gain[at])
        return gain

    def step(self, level: Level, context, symbol, gain) -> np.ndarray:
        """Gains in the contexts of a level, from those in the next shorter ones."""
        if not len(level.codes):
            return gain + level.rest[context]
        code = context * self.size + symbol
        place = np.minimum(np.searchsorted(level.codes, code), len(level.codes) - 1)
        known = level.codes[place] == code
        return np.where(known, level.gain[place], gain + level.rest[context])

    def add(self, contexts: list[tuple[int, ...]]) -> None:
        """Append a level of candidate contexts; their shorter forms are on the level above."""
        shorter = {c: i for i, c in enumerate(self.levels[-1].contexts)} if self.levels else {(): 0}
        keyed = sorted((c[0] * len(shorter) + shorter[c[1:]], c) for c in contexts if c[1:] in shorter)
        nothing = np.zeros(0, np.int64)
        self.levels.append(Level(
            [c for _, c in keyed], np.array([k for k, _ in keyed], np.int64),
            nothing, np.zeros(0), np.zeros(len(keyed)),
        ))

    def learn(self, codes: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> None:
        """Retain contexts of the last level by divergence and smooth what follows them.

        ``codes``, sorted, with their counts; ``totals`` are those of each context, also of
        transitions that are not listed.
        """
        level = self.levels[-1]
        context, symbol = np.divmod(codes, self.size)
        shorter = self.gain_of([c[1:] for c in level.contexts], context, symbol)
        prior = self.base[symbol] * 10.0**shorter
        n = len(level.contexts)
        kinds = np.bincount(context, minlength=n) + 1.0
        listed = np.bincount(context, counts, n)
        expected = np.minimum(np.bincount(context, prior, n), 1 - 1e-9)
        share = counts / totals[context]
        unlisted = np.maximum(totals - listed, 0) / np.maximum(totals, 1)
        test = 2 * np.bincount(context, counts * np.log(share / prior), n)
        with np.errstate(divide="ignore", invalid="ignore"):
            tail = 2 * totals * unlisted * np.log(unlisted / (1 - expected))
        test = test + np.where(unlisted > 0, tail, 0)
        retained = test > kinds + 4 * np.sqrt(2 * kinds)

        smooth = (counts + kinds[context] * prior) / (totals[context] + kinds[context])
        left = 1 - np.bincount(context, smooth, n)
        rest = np.log10(np.maximum(left, 1e-12) / (1 - expected))
        stays = retained[context]
        level.codes = codes[stays]
        level.gain = np.log10(smooth[stays] / self.base[symbol[stays]])
        level.rest = np.where(retained, rest, 0.0)

    def gain_of(self, suffixes: list[tuple[int, ...]], context, symbol) -> np.ndarray:
        """Gains of symbols in the shorter forms of the last level's contexts."""
        gain = np.zeros(len(symbol))
        for d, level in enumerate(self.levels[:-1], 1):
            index = {c: i for i, c in enumerate(level.contexts)}
            of = np.array([index.get(s[-d:], -1) if len(s) >= d else -1 for s in suffixes], np.int64)
            at = np.flatnonzero(of[context] >= 0)
            gain[at] = self.step(level, of[context[at]], symbol[at], gain[at])
        return gain


def lowest_bin(found: list, most: int) -> int | None:
    """From which bin on there are at most ``most`` rows, or None."""
    size, lowest = 0, None
    for r in sorted(found, key=lambda r: -r.bin):
        size += r.rows
        if size > most:
            break
        lowest = r.bin
    return lowest


# --- scoring ---------------------------------------------------------------------------

_SEQUENCE, _WORD, _TEXTS = range(3)
_HELD = 1 << 19  # sequences and words that are asked for together
_TEXT = np.dtype([
    ("key", np.int64), ("has_key", bool), ("n_tokens", np.int64), ("n_known", np.int64),
    ("base", np.float64), ("gain", np.float64),
])
_ASKED = "what int, spot long, block long, h binary, text binary, times binary"
_ANSWERED = "what int, block long, text binary, sum binary, known binary"
_SCORED = "key long, n_tokens long, n_known long, base double, gain double"


def _gains(block: Places, near: list, known, reach, beyond, longest: int):
    """What each place adds to its text's score; (text, hash, times) of sequences that are to be joined.

    Bits: ``known`` of all sequences with a value, ``beyond`` of those that are not near.
    """
    gains, others = np.zeros(len(block.words)), []
    if not longest:
        return gains, (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    ends, first = np.arange(len(block.words)), 1
    if block.codes is not None:
        # Single words, which are asked for by kind.
        found = mixed(block.kinds)
        values, hit = looked_up(near, found)
        gains += values[block.codes]
        held = np.flatnonzero((~hit & may(known, found) & passed(beyond, found))[block.codes])
        others.append((held, found[block.codes[held]]))
        first = 2
    for length in range(first, longest + 2):
        ends = ends[block.before[ends] >= length - 1]
        if not len(ends):
            break
        held, spot = ends, block.hashes(ends, length)
        if length > 1:
            # Where a sequence has no row, neither have those that are longer and end there.
            on = may(reach, spot)
            ends, spot = ends[on], spot[on]
            held = ends
        if length == 1 or known is not reach:
            some = may(known, spot)
            held, spot = held[some], spot[some]
        values, hit = looked_up(near, spot)
        gains[held[hit]] += values[hit]
        held, spot = held[~hit], spot[~hit]
        on = passed(beyond, spot)
        others.append((held[on], spot[on]))
    # Texts have a sequence once, with how often it occurs.
    held, spot = (np.concatenate(c) for c in zip(*others))
    text = np.repeat(np.arange(len(block.starts)), np.diff(np.append(block.starts, len(block.words))))[held]
    order = np.argsort(spot)
    order = order[np.argsort(text[order].astype(np.uint16 if len(block.starts) <= 1 << 16 else np.int64), kind="stable")]
    text, spot = text[order], spot[order]
    other = np.append(True, (text[1:] != text[:-1]) | (spot[1:] != spot[:-1]))[: len(text)]
    new = np.flatnonzero(other)
    return gains, (text[new], spot[new], np.diff(np.append(new, len(text))))


def _asked(model, parts_of: list, bits_of: list, log_spots: int):
    """By block of texts: what memory knows of each, and by the spots of their hashes what it does not know."""

    def out(block: int, texts: list[np.ndarray], asked: list[list]) -> Iterator[pa.RecordBatch]:
        names, none = ("what", "spot", "block", "h", "text", "times"), pa.nulls(1, pa.binary())
        spot = [block % (1 << log_spots)]
        yield rows(names, pa.array([_TEXTS], pa.int32()), spot, [block], [np.concatenate(texts).tobytes()], none, none)
        for what, found in enumerate(asked):
            text, h, times = (np.concatenate(c) for c in zip(*found))
            parts = dealt(h, 1 << log_spots, h=h, text=text.astype(np.uint16), times=times.astype(np.uint32))
            size = len(parts)
            parts = parts.add_column(0, "block", pa.array([block] * size, pa.int64()))
            parts = parts.add_column(0, "what", pa.array([what] * size, pa.int32()))
            yield from parts.select(names).to_batches(4)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, longest = model.value
        near = [part.value for part in parts_of]
        # Without values that are known and not reached, one bitmap does for both.
        reach, beyond = (bits.value for bits in bits_of) if longest else (None, None)
        block = TaskContext.get().partitionId() << 32
        texts, asked, size, held = [], [[], []], 0, 0
        for part in parts:
            if not part.num_rows:
                continue
            kinds, codes, starts = numbered(part.column(1))
            hashes = hashes_of(kinds)
            places = Places(hashes[codes], starts, hashes, codes)
            gains, distant = _gains(places, near, reach, reach, beyond, longest)
            # By word, null where memory does not know it; a beginning is not a token.
            at, hit = logs.places(mixed(hashes[:-1]))
            logs_of = np.append(np.where(hit, logs.values[at], np.nan), 0.0)[codes]
            rare = np.isnan(logs_of)
            sizes = np.diff(np.append(starts, len(codes))) - 1
            one = np.zeros(len(starts), _TEXT)
            one["has_key"] = pc.is_valid(part.column(0)).to_numpy(zero_copy_only=False)
            one["key"] = pc.fill_null(part.column(0), 0).to_numpy()
            one["n_tokens"] = sizes
            one["n_known"] = sizes - np.add.reduceat(rare.astype(np.int64), starts)
            one["base"] = np.add.reduceat(np.where(rare, 0.0, logs_of), starts)
            one["gain"] = np.add.reduceat(gains, starts)
            texts.append(one)

            text = np.repeat(np.arange(len(starts)), sizes + 1)[rare]
            pairs, times = np.unique(text * len(kinds) + codes[rare], return_counts=True)
            owner, code = np.divmod(pairs, len(kinds))
            words = owner, mixed(hashes[code]), times
            for what, (owner, h, times) in enumerate((distant, words)):
                asked[what].append((owner + size, h, times))
                held += len(h)
            size += len(starts)
            if held > _HELD or size > _HELD >> 5:
                yield from out(block, texts, asked)
                texts, asked, size, held, block = [], [[], []], 0, 0, block + 1
        if size:
            yield from out(block, texts, asked)

    return of_parts(run)


def _rare(mass: float, below: int | None, spots: int):
    """Logs of words (h, c) in parts, of bins below one."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            h, c = (values_in(column, kind) for column, kind in zip(part.columns, (np.uint64, np.int64)))
            some = within(c, below, None)
            yield from dealt(h[some], spots, h=h[some], v=np.log10((c[some] + 0.5) / mass)).to_batches(4)

    return run


def _frequent(since: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            h, c = (values_in(column, np.int64) for column in part.columns)
            some = within(c, None, since)
            yield rows(("h", "c"), [h[some].tobytes()], [c[some].tobytes()])

    return run


def _answered(unknown: float):
    """Sums of the values asked for, by text; words without one have ``unknown``, other sequences nothing."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds, values = np.array(right["what"].to_pylist(), int), []
        for what in (_SEQUENCE, _WORD):
            some = np.flatnonzero(kinds == what).tolist()
            h, v = (
                np.concatenate([np.zeros(0, kind), *[np.frombuffer(right[name][i].as_buffer(), kind) for i in some]])
                for name, kind in (("h", np.uint64), ("v", np.float64))
            )
            order = np.argsort(h)
            # One more that is above all others.
            values.append((np.append(h[order], ~np.uint64(0)), np.append(v[order], 0.0)))
        found = []
        for what, block, h, text, times in zip(*[left[k] for k in ("what", "block", "h", "text", "times")]):
            what, block = what.as_py(), block.as_py()
            if what == _TEXTS:
                found.append((what, block, None, h.as_py(), None))
                continue
            h, text, times = (np.frombuffer(b.as_buffer(), k) for b, k in zip((h, text, times), _ASK_TYPES))
            keys, v = values[what]
            at = np.searchsorted(keys[:-1], h)
            hit = keys[at] == h
            hit &= at < len(keys) - 1
            if what == _SEQUENCE:
                text, times, at, hit = text[hit], times[hit], at[hit], hit[hit]
            if len(text):
                sums = np.bincount(text, np.where(hit, v[at], unknown) * times)
                known = np.bincount(text, times * hit).astype(np.uint32)
                some = np.flatnonzero(np.bincount(text))
                known = known[some].tobytes() if what == _WORD else None
                found.append((what, block, some.astype(np.uint32).tobytes(), sums[some].tobytes(), known))
        columns = zip(*found) if found else [[]] * 5
        types = pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
        names = "what", "block", "text", "sum", "known"
        return pa.table({n: pa.array(list(c), t) for n, c, t in zip(names, columns, types)})

    return of_groups(run)


_ASK_TYPES = np.uint64, np.uint16, np.uint32


def _put_together(part: pa.Table) -> pa.Table:
    """A block's texts with all that was found for them."""
    whats = part["what"].to_pylist()
    texts = np.frombuffer(part["sum"][whats.index(_TEXTS)].as_buffer(), _TEXT).copy()
    # In an order that does not depend on what arrives first.
    order = sorted(range(len(whats)), key=lambda i: (whats[i], part["text"][i].as_py() or b"", part["sum"][i].as_py()))
    for i in order:
        if whats[i] == _TEXTS:
            continue
        of = np.frombuffer(part["text"][i].as_buffer(), np.uint32)
        texts["gain" if whats[i] == _SEQUENCE else "base"][of] += np.frombuffer(part["sum"][i].as_buffer(), np.float64)
        if whats[i] == _WORD:
            texts["n_known"][of] += np.frombuffer(part["known"][i].as_buffer(), np.uint32)
    found = {name: np.ascontiguousarray(texts[name]) for name in ("n_tokens", "n_known", "base", "gain")}
    return pa.table({"key": pa.array(np.ascontiguousarray(texts["key"]), mask=~texts["has_key"]), **found})


def score(
    docs: DataFrame,
    held: Column,
    *,
    key: str = "doc_id",
    text: str = "text",
    depth: int | None = 64,
    least: int = 10,
    entry: int = 2,
    common: int = 200_000,
    cached: int = 4_000_000,
    group: int = 64 << 20,
) -> DataFrame:
    """One row per document: key, n_tokens, n_known, train_tokens, base_score, score.

    Documents for which ``held`` is not true train the model. Null and empty texts consist of
    their end. Repeated rows each train the model and each return a row. Without training texts
    every token has the same base probability. Keys are long, or null. Without rows there is no row.
    A long text is one row of a block of 256 texts at most and is read whole. Other columns, whatever
    their names, are not read and not returned.
    """
    spark = docs.sparkSession
    batches(spark, 256, 1 << 20)
    fold = F.coalesce(held, F.lit(False))
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    training = docs.filter(~fold).select(body.alias("body"))
    used: list[str] = []
    with swept(spark):
        counts = stored(token_parts(training, "body"), "token-counts")

        by_bin = numbers_of(counts, "c")
        rare_below = lowest_bin(by_bin, common)
        total, distinct_words = sum(r["sum"] for r in by_bin), sum(r.rows for r in by_bin)
        mass = total + 0.5 * (distinct_words + 1)
        h, c = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if rare_below is not None:
            frequent = counts.select("h", "c").mapInArrow(_frequent(rare_below), "h binary, c binary").toArrow()
            h, c = read(frequent, "h", np.uint64), read(frequent, "c", np.int64)

        # Parts by the highest bits of hashes, some hundred thousand values each, and wider ones to look them up.
        log_parts = max((int(mass) >> 20).bit_length(), 4)
        log_spots = max((int(mass) >> 22).bit_length(), 4)
        grown = grow(training, counts, mass, depth, least, entry, group, log_parts, used)
        near, bits, sent = [], [], spark.sparkContext.broadcast
        longest, distant = 0, None
        if grown is not None:
            tree, longest = grown
            table = modelled(tree)
        if longest:
            by_number = numbers_of(table)
            size = sum(r.rows for r in by_number)
            by_number = [r for r in by_number if r.bin >= 0]
            lowest = lowest_bin(by_number, cached)
            distant = valued(table, below=lowest)
            number = sum(r.rows for r in by_number if lowest is None or r.bin < lowest)
            # Sent as soon as it is here, so that the driver does not hold the model.
            no_bin = 1 << 20  # above all there are
            bits = [sent(bitmap(table, size)), sent(sieve(table, number, no_bin if lowest is None else lowest))]
            if lowest is not None:
                for part in fetched(table, log_parts, lowest):
                    near.append(sent(part))
                    del part
                    given_back()
        batches(spark, 256, 1 << 20)
        for folder in used:
            remove_folder(spark, folder)

    model = sent((Values(h, np.log10((c + 0.5) / mass)), longest))
    del h, c
    given_back()
    asked = docs.select(F.col(f"`{key}`").cast("long").alias("key"), body.alias("body")).mapInArrow(
        _asked(model, near, bits, log_spots), _ASKED
    )
    values = counts.select("h", "c").mapInArrow(
        _rare(mass, rare_below, 1 << log_spots), "spot long, h binary, v binary"
    )
    values = values.select(F.lit(_WORD).alias("what"), "*")
    if distant is not None:
        spot = F.shiftright("spot", log_parts - log_spots).alias("spot")
        values = values.unionByName(distant.select(F.lit(_SEQUENCE).alias("what"), spot, "h", "v"))
    unknown = float(np.log10(0.5 / mass))
    answered = asked.groupBy("spot").cogroup(values.groupBy("spot")).applyInArrow(_answered(unknown), _ANSWERED)
    per_row = answered.groupBy("block").applyInArrow(of_group(_put_together), _SCORED)
    return per_row.select(
        F.col("key").alias(key),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("base") + F.col("gain")).alias("score"),
    )
