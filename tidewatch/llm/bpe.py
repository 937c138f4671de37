"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A block of texts is cut into pieces by the tokenizer's pattern. Its distinct pieces form one
corpus: all their bytes stand in one array, and an inverted index leads from each pair that can
merge to the positions where it stands. Merges are replayed in rank order, each at all its
positions at once, and only the neighbours a merge touches enter the index anew. Texts are then
put together from the encoded pieces. No row leaves its partition, so nothing is shuffled, and a
lost task is simply run again.
"""

import base64
import heapq
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache
from itertools import islice
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, own_names

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Words that have come up again whose ids a worker remembers, and half as many that have not.
REMEMBERED = 300_000
_SHIFT = 32


class Vocabulary:
    """Token bytes by id, and for each pair of ids that can merge the id it becomes."""

    def __init__(self, path: str):
        lines = map(bytes.split, Path(path).read_bytes().splitlines())
        self.rank = {base64.b64decode(token): int(rank) for token, rank in filter(None, lines)}
        self.token = {rank: token for token, rank in self.rank.items()}
        pairs = [
            (left << _SHIFT | right, rank)
            for token, rank in self.rank.items()
            for at in range(1, len(token))
            if (left := self.rank.get(token[:at])) is not None
            and (right := self.rank.get(token[at:])) is not None
        ]
        pairs.sort()
        self.merges = dict(pairs)
        self.keys = np.array([k for k, _ in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.becomes = np.array([r for _, r in pairs] + [-1], np.int64)
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id that each pair becomes, -1 where it can't merge."""
        key = left.astype(np.int64) << _SHIFT | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.becomes[at], -1)

    def plain(self, piece: bytes) -> list[int]:
        """The ids of one piece: always the first pair of least rank merges."""
        parts = [self.rank[bytes([b])] for b in piece]
        while len(parts) > 1:
            ranks = self.merged(np.array(parts[:-1]), np.array(parts[1:]))
            if not (ranks >= 0).any():
                break
            at = int(np.where(ranks < 0, np.iinfo(np.int64).max, ranks).argmin())
            parts[at : at + 2] = [int(ranks[at])]
        return parts


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: Up to so many positions, a merge is applied one by one; vectors pay off beyond.
_FEW = 24


class _Replay:
    """All merges of a corpus of pieces that stand in one array of tokens."""

    def __init__(self, pieces: list[bytes], vocab: Vocabulary):
        self.vocab, self.pieces = vocab, pieces
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        first = np.cumsum(size) - size
        self.token = vocab.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(self.token)
        self.before, self.after = (np.arange(a, a + n, dtype=np.int32) for a in (-1, 1))
        self.before[first] = -1
        self.after[first + size - 1] = -1
        self.owner = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
        self.pair = np.full(n, -1, np.int32)  # what the pair that begins here merges to
        self.odd: set[int] = set()  # pieces in which a merge enables one of lower rank
        # The inverted index: rank to positions, single ones and arrays of them.
        self.single: dict[int, list[int]] = {}
        self.many: dict[int, list[np.ndarray]] = {}
        self.due: list[int] = []
        pairs = np.flatnonzero(self.after >= 0)
        self.pair[pairs] = vocab.merged(self.token[pairs], self.token[pairs + 1])
        self._enter(pairs, self.pair[pairs])

    def _enter(self, left: np.ndarray, rank: np.ndarray) -> None:
        fits = rank >= 0
        left, rank = left[fits], rank[fits]
        if not len(left):
            return
        order = np.argsort(rank, kind="stable")
        left, rank = left[order], rank[order]
        cuts = np.append(np.flatnonzero(rank[1:] != rank[:-1]) + 1, len(rank)).tolist()
        start = 0
        for end in cuts:
            r = int(rank[start])
            if r not in self.many:
                self.many[r] = []
                heapq.heappush(self.due, r)
            self.many[r].append(left[start:end])
            start = end

    def run(self) -> None:
        while self.due:
            rank = heapq.heappop(self.due)
            single, many = self.single.pop(rank, []), self.many.pop(rank, [])
            if len(single) + sum(map(len, many)) <= _FEW:
                for some in many:
                    single += some.tolist()
                self._few(rank, sorted(single))
            elif single or many:
                many.append(np.array(single, np.int64))
                self._vector(rank, np.concatenate(many))

    def _few(self, rank: int, positions: list[int]) -> None:
        token, before, after, pair = self.views
        merges, single = self.vocab.merges, self.single
        for i in positions:
            if pair[i] != rank:
                continue
            j = after[i]
            h, k = before[i], after[j]
            token[i], token[j], pair[j], after[i] = rank, -1, -1, k
            new = -1
            if k >= 0:
                before[k] = i
                new = merges.get(rank << _SHIFT | token[k], -1)
            pair[i] = new
            for at, r in ((i, new), (h, merges.get(token[h] << _SHIFT | rank, -1) if h >= 0 else -1)):
                if at == h and h >= 0:
                    pair[h] = r
                if r >= 0:
                    if r < rank:
                        self.odd.add(int(self.owner[at]))
                    if r in single:
                        single[r].append(at)
                    else:
                        single[r] = [at]
                        heapq.heappush(self.due, r)

    def _vector(self, rank: int, left: np.ndarray) -> None:
        token, before, after, pair = self.token, self.before, self.after, self.pair
        left = left[pair[left] == rank]
        if not len(left):
            return
        left.sort()
        fresh = np.ones(len(left), bool)
        np.not_equal(left[1:], left[:-1], out=fresh[1:])
        left = left[fresh]
        right = after[left]
        chained = np.flatnonzero(right[:-1] == left[1:])
        if len(chained):  # in a run of overlapping pairs, every other one merges
            place = np.arange(len(left))
            start = place.copy()
            start[chained + 1] = 0
            taken = (place - np.maximum.accumulate(start)) % 2 == 0
            left, right = left[taken], right[taken]
        beyond = after[right]
        token[left], token[right], pair[right], pair[left] = rank, -1, -1, -1
        after[left] = beyond
        inner = beyond >= 0
        before[beyond[inner]] = left[inner]
        ahead = before[left]
        changed = np.concatenate((left[inner], ahead[ahead >= 0]))
        changed = changed[token[changed] >= 0]
        becomes = self.vocab.merged(token[changed], token[after[changed]])
        pair[changed] = becomes
        lower = changed[(becomes >= 0) & (becomes < rank)]
        if len(lower):
            self.odd.update(self.owner[lower].tolist())
        self._enter(changed, becomes)

    def encoded(self) -> list[bytes]:
        self.views = tuple(map(memoryview, (self.token, self.before, self.after, self.pair)))
        self.run()
        stays = self.token >= 0
        ids = self.token[stays].astype("<u4").tobytes()
        sizes = np.bincount(self.owner[stays], minlength=len(self.pieces))
        ends = (4 * np.cumsum(sizes)).tolist()
        encoded = [ids[a:b] for a, b in zip([0, *ends], ends)]
        for i in self.odd:
            encoded[i] = np.array(self.vocab.plain(self.pieces[i]), "<u4").tobytes()
        return encoded


def replay(pieces: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """Ids of each piece (not empty), as little-endian unsigned 32-bit integers."""
    return _Replay(pieces, vocab).encoded() if pieces else []


class Encoder:
    """Encodes blocks of texts; remembers the words that come up again.

    The public pattern never joins what a single white space parts: if no two stand together in
    a text, its words can be encoded one by one, each with the space or line break before it.
    Other texts are cut as a whole, and so are all under another pattern.
    """

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        self.vocab, self.find = vocabulary(path), regex.compile(pattern).findall
        self.remembered = remembered
        by_word = pattern == public_tokenizers.PATTERN
        self.joined = regex.compile(r"\s\s" if by_word else "").search
        self.known: dict[str, bytes] = {}  # words that have come up at least twice
        self.young: dict[str, bytes] = {}  # words that have come up once

    def _encoded(self, found: list[list[str]]) -> list[bytes]:
        """The ids of lists of pieces; each different piece is merged once."""
        pieces = list({piece for some in found for piece in some})
        ids = dict(zip(pieces, replay([p.encode() for p in pieces], self.vocab)))
        return [b"".join([ids[p] for p in some]) for some in found]

    def _cut(self, word: str) -> list[str]:
        """The pieces of a word and the white space before it; plain words need no pattern."""
        if word.isalpha():
            return [" " + word]
        if word[-1:] in (".", ",") and word[:-1].isalpha():
            return [" " + word[:-1], word[-1]]
        return self.find(word if word[:1] == "\n" else " " + word)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        if len(self.known) > self.remembered:  # the older half holds the frequent words
            self.known = dict(islice(self.known.items(), self.remembered // 2))
        if len(self.young) > self.remembered // 2:
            self.young = {}
        get, parts = self.known.get, []
        heads: list[list[str]] = []  # pieces of what stands first in each text
        words_, texts_, places = [], [], []  # words that aren't known, and where they stand
        for i, text in enumerate(texts):
            if self.joined(text):
                heads.append(self.find(text))
                parts.append([b""])
                continue
            # A line's first word keeps its break, all others have a space before them.
            words = text.replace("\n", " \n").split(" ")
            heads.append(self.find(words[0]))
            here = list(map(get, words))
            here[0] = b""
            parts.append(here)
            at = -1
            for _ in range(here.count(None)):
                at = here.index(None, at + 1)
                words_.append(words[at])
                texts_.append(i)
                places.append(at)
        missing = Counter(words_)
        again = {w: self.young.pop(w) for w in missing.keys() & self.young.keys()}
        new = list(missing.keys() - again.keys())
        encoded = self._encoded(heads + list(map(self._cut, new)))
        fresh = dict(zip(new, encoded[len(heads) :]))
        for word, ids in fresh.items():
            (again if missing[word] > 1 else self.young)[word] = ids
        self.known.update(again)
        ids = {**again, **fresh}
        for i, at, word in zip(texts_, places, words_):
            parts[i][at] = ids[word]
        for here, head in zip(parts, encoded):
            here[0] = head
        return [b"".join(here) for here in parts]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str, remembered: int) -> Encoder:
    """One for each Python worker and vocabulary."""
    return Encoder(path, pattern, remembered)


def decode_ids(ids: bytes, vocab: Vocabulary) -> bytes:
    return b"".join(map(vocab.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _text(value: str | None) -> str:
    return value or ""


def encode_column(
    text: Column,
    path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
    remembered: int = REMEMBERED,
) -> Column:
    """Ids of a text, packed as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        ids = encoder(path, pattern, remembered).encode(map(_text, texts))
        return pd.Series(ids, dtype=object)

    return of(text)


def length_column(
    text: Column,
    path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
    remembered: int = REMEMBERED,
) -> Column:
    """Number of ids of a text."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        ids = encoder(path, pattern, remembered).encode(map(_text, texts))
        return pd.Series([len(i) >> 2 for i in ids], dtype="int64")

    return of(text)


def decode_column(ids: Column, path: str = RANKS) -> Column:
    """UTF-8 bytes of packed ids; null for null."""

    @F.pandas_udf("binary")
    def of(packed: pd.Series) -> pd.Series:
        vocab = vocabulary(path)
        return pd.Series(
            [None if p is None else decode_ids(p, vocab) for p in packed], dtype=object
        )

    return of(ids)


def encode(
    docs: DataFrame,
    *,
    text: str = "text",
    path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
    rows: int = 2048,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """The documents with ``ids`` (packed, as ``encode_column``) and ``n_tokens``.

    Null and empty texts have no ids (empty, not null). Repeated rows are encoded alike. Input
    columns named ``ids`` or ``n_tokens`` are replaced. ``rows`` bounds a block, as do 32 MB, and
    ``remembered`` the words a worker keeps between blocks: less of both takes less memory and
    more time.
    """
    batches(docs.sparkSession, rows)
    encoded = own_names(
        docs, ids=encode_column(F.col(f"`{text}`"), path, pattern, remembered)
    )
    return own_names(encoded, n_tokens=(F.octet_length("ids") / 4).cast("long"))


def decode(encoded: DataFrame, *, ids: str = "ids", path: str = RANKS) -> DataFrame:
    """The rows with ``decoded``, the bytes of their ids; null where ids are null."""
    return own_names(encoded, decoded=decode_column(F.col(f"`{ids}`"), path))
