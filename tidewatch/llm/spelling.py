"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters.

A word's letters, each numbered by its occurrence (the second ``a`` of a word is another element
than the first), are a binary vector. Replacing a letter changes two elements of it, inserting or
deleting one changes one. Elements are dealt into parts, evenly by how often they occur. Of n
parts, n - 2 agree whole between words of one length that are near, and n - 1 between near words
whose lengths differ by one: so every subset of that many parts is enumerated, and its contents are
a signature. Near words share one, exactly; words are joined on them and each joined pair is
verified by its edit distance.

The edit lies in one half of a word and leaves the other as it is. Each signature is therefore
taken twice, with the first and with the last half: this loses no pair and splits up the groups of
words that are made of the same letters.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lower_ascii

_LETTERS = "A-Za-z\\u00C0-\\u00FF"
_ODD = 0x9E3779B97F4A7C15
_BASE = np.uint64(_ODD)
#: Occurrences told apart when parts are dealt, and code points: those beyond share a part.
_OCCURRENCES, _CODES = 4, 256
_SLICE = 1 << 20
BOTH, SHORT, LONG = 0, 1, 2


def runs(docs: DataFrame, *, id: str = "doc_id", text: str = "text", least: int = 7) -> DataFrame:
    """(id, run): every maximal run of letters of at least ``least``, A-Z in lower case.

    Whole texts of any length; null and empty ones have none.
    """
    pattern = F.lit(f"[{_LETTERS}]{{{least},}}")
    found = F.regexp_extract_all(F.coalesce(F.col(f"`{text}`"), F.lit("")), pattern, F.lit(0))
    each = docs.select(F.col(f"`{id}`").alias("id"), F.explode(found).alias("run"))
    return each.select("id", lower_ascii(F.col("run")).alias("run"))


def misspelled(rows: DataFrame, every: int = 31) -> DataFrame:
    """(word): the runs, of which one in ``every`` lacks a letter, chosen by id and run.

    A null id counts as an empty one.
    """
    text = F.coalesce(F.col("id").cast("string"), F.lit(""))
    lot = rows.withColumn("h", F.crc32(F.concat(text, F.lit(":"), F.col("run")).cast("binary")))
    at = F.pmod("h", F.length("run")).cast("int")
    without = F.concat(F.left("run", at), F.substr("run", at + 2))
    return lot.select(
        F.when(F.col("h") % every == 0, without).otherwise(F.col("run")).alias("word")
    )


def counted(words: DataFrame, *, least: int = 7, seen: int = 2) -> DataFrame:
    """(word, n): different words of at least ``least`` letters that occur ``seen`` times."""
    return (
        words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
        .where(F.col("n") >= seen)
    )


# --- signatures --------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads what differs in few bits."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Letters:
    """The letters of some words: code, occurrence and place of each, word after word."""

    def __init__(self, words: list[str]):
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.codes = np.frombuffer(
            "".join(words).encode("utf-32-le"), dtype=np.uint32
        ).astype(np.int64)
        word = np.repeat(np.arange(len(words)), self.lengths)
        order = np.lexsort((self.codes, word))
        code, of = self.codes[order], word[order]
        fresh = np.ones(len(code), dtype=bool)
        fresh[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
        index = np.arange(len(code))
        #: Elements stand by code within their word; their word's range is that of its letters.
        self.element_codes = code
        self.occurrences = index - np.maximum.accumulate(np.where(fresh, index, 0))

    def cells(self) -> np.ndarray:
        """Where in a table of parts each element looks its part up."""
        seen = np.minimum(self.occurrences, _OCCURRENCES - 1)
        return self.element_codes % _CODES * _OCCURRENCES + seen

    def contents(self, parts: np.ndarray, n: int) -> np.ndarray:
        """A number for what each word has in each part: (words, n)."""
        element = _mixed((self.element_codes << 32) + self.occurrences + 1)
        part = parts[self.cells()]
        sums = [np.add.reduceat(np.where(part == p, element, np.uint64(0)), self.starts)
                for p in range(n)]
        return np.stack([_mixed(s + np.uint64((p + 1) * _ODD % 2**64)) for p, s in enumerate(sums)], axis=1)

    def halves(self, of: np.ndarray) -> list[np.ndarray]:
        """Numbers for the beginning and the end of each word, as its ``of`` letters divide."""
        powers = np.cumprod(np.full(int(self.lengths.max()) + 1, _BASE))
        place = np.arange(len(self.codes)) - np.repeat(self.starts, self.lengths)
        letters = _mixed(self.codes + 1)
        zero = np.zeros(1, dtype=np.uint64)
        ahead = np.concatenate([zero, np.cumsum(letters * powers[place])])
        from_end = np.repeat(self.lengths, self.lengths) - 1 - place
        back = np.concatenate([zero, np.cumsum(letters * powers[from_end])])
        first, last = of // 2, of - of // 2
        end = self.starts + self.lengths
        return [ahead[self.starts + first] - ahead[self.starts],
                _mixed(back[end] - back[end - last])]


def _keys(contents: np.ndarray, halves: list[np.ndarray], of: np.ndarray, agree: int, kind: int
          ) -> Iterator[np.ndarray]:
    """A key for each word, subset of ``agree`` parts and half; ``of`` is the shorter length."""
    for i, subset in enumerate(combinations(range(contents.shape[1]), agree)):
        signature = _mixed(contents[:, subset].sum(axis=1, dtype=np.uint64)
                           + of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        for j, half in enumerate(halves):
            salt = np.uint64((kind * 4096 + i * 2 + j + 1) * 0x2545F4914F6CDD1D & (2**64 - 1))
            yield _mixed((signature ^ salt) + _mixed(half + salt))


def signatures(words: list[str], replaced: np.ndarray, inserted: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
    """(keys, kinds), both (words, signatures); tables tell the part of each cell."""
    letters, columns, kinds = Letters(words), [], []

    def add(parts: np.ndarray, off: int, of: np.ndarray, role: int) -> None:
        n = int(parts.max()) + 1
        found = _keys(letters.contents(parts, n), letters.halves(of), of, n - off, off)
        for key in found:
            columns.append(key)
            kinds.append(np.full(len(words), role, dtype=np.int64))

    add(replaced, 2, letters.lengths, BOTH)
    add(inserted, 1, letters.lengths, SHORT)
    add(inserted, 1, letters.lengths - 1, LONG)
    return np.stack(columns, axis=1), np.stack(kinds, axis=1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Words and their counts, so many that their letters are bounded, one word at least."""
    for batch in batches:
        words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
        ends = np.cumsum([len(w) for w in words])
        at = 0
        while at < len(words):
            limit = (ends[at - 1] if at else 0) + _SLICE
            to = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
            yield words[at:to], n[at:to]
            at = to


def _dealt(frequency: np.ndarray, parts: int) -> np.ndarray:
    """The part of each cell: the most frequent first, each to the emptiest part."""
    load, dealt = np.zeros(parts), np.arange(len(frequency)) % parts
    for cell in np.argsort(-frequency, kind="stable"):
        if frequency[cell]:
            dealt[cell] = load.argmin()
            load[dealt[cell]] += frequency[cell]
    return dealt


def _frequency(words: DataFrame) -> np.ndarray:
    """How many words have each element; the table of cells is all that reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CODES * _OCCURRENCES, dtype=np.int64)
        for part, _ in _slices(batches):
            total += np.bincount(Letters(part).cells(), minlength=len(total))
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": cell, "n": total[cell]})

    found = words.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    total = np.zeros(_CODES * _OCCURRENCES, dtype=np.int64)
    for row in found.collect():
        total[row.cell] = row.n
    return total


def near_pairs(words: DataFrame, *, replaced: int = 4, inserted: int = 2) -> DataFrame:
    """(word, n, other, other_n): each ordered pair of words (word, n) that are one edit apart.

    ``word`` holds different texts, none empty or null. ``replaced`` (3 or more) and ``inserted``
    (2 or more) are the numbers of parts; more of them make more, narrower signatures.
    """
    frequency = _frequency(words)
    for_replaced, for_inserted = _dealt(frequency, replaced), _dealt(frequency, inserted)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, n in _slices(batches):
            keys, kinds = signatures(part, for_replaced, for_inserted)
            each = np.repeat(np.arange(len(part)), keys.shape[1])
            yield pa.RecordBatch.from_pydict({
                "key": keys.reshape(-1).view(np.int64),
                "tag": n[each] * 4 + kinds.reshape(-1),
                "word": pa.array(part, pa.string()).take(pa.array(each)),
            })

    signed = words.mapInArrow(sign, "key long, tag long, word string")
    a, b = signed.alias("a"), signed.alias("b")
    # Written over both sides at once, so that both read one shuffle of the signatures.
    kinds = F.col("a.tag").bitwiseAND(3) * 4 + F.col("b.tag").bitwiseAND(3)
    ordered = ((kinds == BOTH) & (F.col("a.word") < F.col("b.word"))) | (kinds == SHORT * 4 + LONG)
    found = a.join(
        b, (F.col("a.key") == F.col("b.key")) & ordered
        & (F.levenshtein("a.word", "b.word", 1) == 1)
    )

    def side(one: str, two: str) -> Column:
        return F.struct(
            F.col(f"{one}.word").alias("word"), F.shiftright(f"{one}.tag", 2).alias("n"),
            F.col(f"{two}.word").alias("other"), F.shiftright(f"{two}.tag", 2).alias("other_n"),
        )

    both = found.select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("p")).select("p.*")
    return both.repartition("word").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following forms (word, form) ends, by paths that double each round.

    A form has ten times the occurrences of its word, so the rounds are few.
    """
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = cut(now.join(ahead, "root", "left"))
        now = further.select("word", F.coalesce("next", "root").alias("root"))
        if further.where("next IS NOT NULL").isEmpty():
            return now


def variants(words: DataFrame, *, ratio: int = 10, **parts: int) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of (word, n).

    Near are words that differ by exactly one inserted, deleted or replaced code point. The form is
    the most frequent near word (of ties the first in code-point order) if it has ``ratio`` (more
    than one) times the word's occurrences, else null; the root is the last form there is, from the word
    on. Words that repeat are added up, null and empty words are none; an empty table has no rows.
    """
    kept = cut(
        words.where(F.length("word") > 0).groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    )
    near = near_pairs(kept, **parts)
    # Struct order: the largest count, then the smallest word.
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form")))
    judged = cut(
        near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
        .withColumn("fits", -F.col("best.minus") >= ratio * F.col("n"))
        .select(
            "word", "n_near", F.when(F.col("fits"), F.col("best.form")).alias("form"),
            F.when(F.col("fits"), -F.col("best.minus")).alias("form_n"),
        )
    )
    roots = _roots(judged.where("form IS NOT NULL"))
    return kept.join(judged, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )
