"""Toxicity by a convolutional text classifier.

Words are hashed into an embedding table; filters of several widths run over the whole text, the
strongest response of each filter counts (max pooling), and a logistic layer scores these. The
network is trained in numpy on all labelled documents, in blocks where the texts are, whose moves
are averaged round by round. Its scores are calibrated to probabilities on a fifth of the documents
left out of training, and a threshold is chosen there for each language. Only the model travels.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, cut, own_names
from .suffix_tree import stored

BUCKETS = 1 << 20
WIDTHS = (1, 2, 3)
_PADS = max(WIDTHS) - 1
_WORD = regex.compile(r"\w+").findall
_REMEMBERED = 200_000
_STEPS = 120_000  # texts to learn from, repeats included, before three rounds are enough


#: Beginnings of a word that are hashed beside the word itself, so that inflected forms share.
_STEMS = (3, 5, 7)


def _buckets(word: str) -> list[int]:
    """Buckets of a word and of its beginnings; 0 stands for none."""
    raw = [word, *[f"{word[:n]}-" if len(word) > n else "" for n in _STEMS]]
    return [1 + zlib.crc32(x.encode("utf-8", "replace")) % (BUCKETS - 1) if x else 0 for x in raw]


class _Lexicon(dict):
    """Word to slot; a slot holds the word's buckets. Slot 0 is padding."""

    def __init__(self):
        super().__init__()
        self.rows = [[0] * (1 + len(_STEMS))]

    def __missing__(self, word: str) -> int:
        slot = self[word] = len(self.rows)
        self.rows.append(_buckets(word))
        return slot


def _flat(texts: list[str], lexicon: _Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all texts, each followed by padding, and where each begins."""
    out, starts = [], []
    for text in texts:
        starts.append(len(out))
        out += [lexicon[w] for w in _WORD(text.lower())]
        out += [0] * _PADS
    return np.array(out, np.int64), np.array(starts, np.int64)


@dataclass
class Network:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width: [width * dimensions, filters]
    bias: dict[int, np.ndarray]
    weight: np.ndarray
    offset: float
    known: np.ndarray  # buckets that training has met often enough
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str | None, float] = field(default_factory=dict)
    _memory: tuple[_Lexicon, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        """Without the rows of unknown buckets, which are most, and without the memory."""
        buckets = np.flatnonzero(self.known).astype(np.int32)
        rows = self.embedding[buckets]
        return {**vars(self), "known": buckets, "embedding": rows, "_memory": None}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        buckets, rows = state["known"], state["embedding"]
        self.known = np.zeros(BUCKETS, bool)
        self.known[buckets] = True
        self.embedding = np.zeros((BUCKETS, rows.shape[1]), np.float32)
        self.embedding[buckets] = rows

    @classmethod
    def fresh(cls, known: np.ndarray, prior: float, dimensions: int = 8, filters: int = 8):
        dice = np.random.default_rng(11)
        # Words begin without meaning, so that unseen ones stay without; the filters differ.
        return cls(
            np.zeros((BUCKETS, dimensions), np.float32),
            {k: dice.normal(0, 0.5, (k * dimensions, filters)).astype(np.float32) for k in WIDTHS},
            {k: np.full(filters, 0.01, np.float32) for k in WIDTHS},
            dice.normal(0, 0.3, len(WIDTHS) * filters).astype(np.float32),
            float(np.log(prior / (1 - prior))),
            known,
        )

    def vectors(self, rows: list[list[int]]) -> np.ndarray:
        """The meaning of words given by their buckets."""
        buckets = np.array(rows, np.int64).reshape(-1, 1 + len(_STEMS))
        return self.embedding[np.where(self.known[buckets], buckets, 0)].sum(axis=1)

    def responses(self, vectors: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
        """Each filter's response at each position; a window that begins in padding is blank."""
        padded = np.concatenate((vectors, np.zeros((k - 1, vectors.shape[1]), np.float32)))
        windows = np.concatenate([padded[i : i + len(vectors)] for i in range(k)], axis=1)
        out = windows @ self.filters[k] + self.bias[k]
        ends = np.append(starts[1:], len(vectors))
        for i in range(1, _PADS + 1):
            out[ends - i] = self.bias[k]
        return out

    def logits(self, texts: list[str]) -> np.ndarray:
        """The last layer's output; remembers the words it has met, up to a bound."""
        if not texts:
            return np.zeros(0)
        if self._memory is None or len(self._memory[0]) > _REMEMBERED:
            self._memory = _Lexicon(), np.zeros((0, self.embedding.shape[1]), np.float32)
        lexicon, known = self._memory
        slots, starts = _flat(texts, lexicon)
        known = np.concatenate((known, self.vectors(lexicon.rows[len(known) :])))
        self._memory = lexicon, known
        return self.pooled(known[slots], starts)

    def pooled(self, vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Logits of texts whose words have these meanings."""
        tops = [np.maximum.reduceat(self.responses(vectors, starts, k), starts) for k in WIDTHS]
        return np.maximum(np.concatenate(tops, axis=1), 0) @ self.weight + self.offset

    def dense(self) -> np.ndarray:
        """All parameters but the embedding, one after the other."""
        return self.flat({"weight": self.weight, "offset": self.offset}
                         | {("filters", k): self.filters[k] for k in WIDTHS}
                         | {("bias", k): self.bias[k] for k in WIDTHS})

    def flat(self, values: dict) -> np.ndarray:
        names = ["weight", "offset", *[(n, k) for k in WIDTHS for n in ("filters", "bias")]]
        return np.concatenate([np.ravel(values[n]) for n in names]).astype(float)

    def named(self, values: np.ndarray) -> dict:
        """Parts of what flat() has put together, by name."""
        shapes = {"weight": self.weight.shape, "offset": ()}
        for k in WIDTHS:
            shapes["filters", k], shapes["bias", k] = self.filters[k].shape, self.bias[k].shape
        out, at = {}, 0
        for name, shape in shapes.items():
            size = int(np.prod(shape))
            out[name] = values[at : at + size].reshape(shape)
            at += size
        return out

    def settle(self, values: np.ndarray) -> None:
        """Take the parameters that dense() gives."""
        parts = self.named(values.astype(np.float32))
        self.weight, self.offset = parts["weight"], float(parts["offset"])
        self.filters = {k: parts["filters", k] for k in WIDTHS}
        self.bias = {k: parts["bias", k] for k in WIDTHS}

    def scores(self, texts: list[str]) -> np.ndarray:
        logits = self.scale * self.logits(texts).astype(float) + self.shift
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))

    def learn(self, slots, starts, rows, target, importance, speed, rate: float):
        """One step of Adagrad on a batch; max pooling passes gradients to the top window only.

        ``rows`` has the buckets of each slot.
        """
        ends = np.append(starts[1:], len(slots))
        vectors = self.embedding[rows[slots]].sum(axis=1)
        tops, where = [], []
        for k in WIDTHS:
            out = self.responses(vectors, starts, k)
            at = np.stack([a + out[a:b].argmax(axis=0) for a, b in zip(starts, ends)])
            where.append(at)
            tops.append(np.take_along_axis(out, at, axis=0))
        pooled = np.maximum(np.concatenate(tops, axis=1), 0)
        logit = pooled @ self.weight + self.offset
        error = ((1 / (1 + np.exp(-np.clip(logit, -60, 60)))) - target) * importance / len(target)
        back = (np.outer(error, self.weight) * (pooled > 0)).astype(np.float32)

        touched, slopes, column = [], [], 0
        steps = {"weight": pooled.T @ error + 1e-4 * self.weight, "offset": error.sum()}
        dimensions = self.embedding.shape[1]
        padded = np.concatenate((vectors, np.zeros((_PADS, dimensions), np.float32)))
        words = np.concatenate((slots, np.zeros(_PADS, np.int64)))
        for k, at in zip(WIDTHS, where):
            count = self.filters[k].shape[1]
            part = back[:, column : column + count]
            column += count
            window = at[:, :, None] + np.arange(k)  # [texts, filters, k]
            seen = padded[window].reshape(*at.shape, k * dimensions)
            steps["filters", k] = np.einsum("tf,tfd->df", part, seen) + 1e-4 * self.filters[k]
            steps["bias", k] = part.sum(axis=0)
            slope = part[:, :, None] * self.filters[k].T[None]
            touched.append(words[window].reshape(-1))
            slopes.append(slope.reshape(-1, dimensions))
        buckets = rows[np.concatenate(touched)]
        each = np.repeat(np.concatenate(slopes), buckets.shape[1], axis=0)
        buckets, place = np.unique(buckets.reshape(-1), return_inverse=True)
        total = np.zeros((len(buckets), dimensions), np.float32)
        np.add.at(total, place.reshape(-1), each)
        total += 1e-4 * self.embedding[buckets]
        speed["embedding"][buckets] += total * total
        self.embedding[buckets] -= rate * total / (np.sqrt(speed["embedding"][buckets]) + 1e-6)
        self.embedding[0] = 0

        def move(name, value, slope):
            speed[name] = speed.get(name, 1e-8) + slope * slope
            return value - rate * slope / np.sqrt(speed[name])

        self.weight = move("weight", self.weight, steps["weight"]).astype(np.float32)
        self.offset = float(move("offset", self.offset, steps["offset"]))
        for k in WIDTHS:
            self.filters[k] = move(("filters", k), self.filters[k], steps["filters", k]).astype(np.float32)
            self.bias[k] = move(("bias", k), self.bias[k], steps["bias", k]).astype(np.float32)


def _calibrate(logits: np.ndarray, target: np.ndarray, importance: np.ndarray) -> tuple[float, float]:
    """Scale and shift that turn logits into log odds, by damped Newton steps."""
    x = np.stack([logits, np.ones_like(logits)], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -60, 60)))
        slope = x.T @ ((p - target) * importance) + 1e-2 * (at - [1.0, 0.0])
        bend = (x * (p * (1 - p) * importance)[:, None]).T @ x + 1e-2 * np.eye(2)
        at = at - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return max(float(at[0]), 1e-3), float(at[1])


def _threshold(score: np.ndarray, target: np.ndarray, importance: np.ndarray) -> float:
    """The score from which on flagging has the best F1."""
    order = np.argsort(-score, kind="stable")
    score, hit, all_ = score[order], (target * importance)[order], importance[order]
    f1 = 2 * np.cumsum(hit) / (np.cumsum(all_) + hit.sum())
    best = int(f1.argmax())
    after = score[best + 1] if best + 1 < len(score) else 0.0
    return float((score[best] + after) / 2)


def train(
    texts: list[str],
    target: np.ndarray,
    importance: np.ndarray,
    langs: list[str | None],
    *,
    epochs: int = 6,
    batch: int = 32,
    least_documents: int = 3,
    least_positives: int = 20,
) -> Network:
    """Train on four fifths, calibrate scores and thresholds on the fifth left out.

    Only words, or beginnings, of at least ``least_documents`` texts get a meaning. A language without
    ``least_positives`` of either label in the fifth takes the common threshold.
    """
    lexicon = _Lexicon()
    parts = [_flat([t], lexicon)[0] for t in texts]
    rows = np.array(lexicon.rows, np.int64)
    seen = np.zeros(BUCKETS, np.int32)
    for slots in parts:
        seen[np.unique(rows[slots])] += 1
    known = seen >= least_documents
    known[0] = False
    prior = (float((target * importance).sum()) + 0.5) / (float(importance.sum()) + 10)
    net = Network.fresh(known, prior)
    if len(set(target.tolist())) < 2:
        net.thresholds = {None: 0.5}
        net.weight[:] = 0
        return net
    order = np.random.default_rng(5).permutation(len(texts))
    aside, fit = order[: len(order) // 5], order[len(order) // 5 :]
    rows = np.where(known[rows], rows, 0)
    speed = {"embedding": np.full(net.embedding.shape, 1e-8, np.float32)}
    # Both labels weigh alike while training; calibration brings their true shares back.
    balance = np.where(target > 0, 0.5 / max(target[fit].mean(), 1e-6), 0.5 / max(1 - target[fit].mean(), 1e-6))
    dice, net.offset = np.random.default_rng(3), 0.0
    for epoch in range(epochs):
        dice.shuffle(fit)
        for at in range(0, len(fit), batch):
            chosen = fit[at : at + batch]
            slots = np.concatenate([parts[i] for i in chosen])
            sizes = [len(parts[i]) for i in chosen]
            starts = np.cumsum([0, *sizes[:-1]])
            rate = 0.1 / (1 + epoch / 2)
            net.learn(slots, starts, rows, target[chosen], balance[chosen], speed, rate)
    checked = aside if len(set(target[aside].tolist())) == 2 else order
    logits = net.logits([texts[i] for i in checked]).astype(float)
    net.scale, net.shift = _calibrate(logits, target[checked], importance[checked])
    score = 1 / (1 + np.exp(-np.clip(net.scale * logits + net.shift, -60, 60)))
    net.thresholds = {None: _threshold(score, target[checked], importance[checked])}
    spoken = np.array([langs[i] or "" for i in checked])
    for lang in sorted(set(spoken.tolist()) - {""}):
        own = np.flatnonzero(spoken == lang)
        hits = int(target[checked][own].sum())
        if least_positives <= hits <= len(own) - least_positives:
            net.thresholds[lang] = _threshold(score[own], target[checked][own], importance[checked][own])
    return net


def fit_sample(
    docs: DataFrame,
    labels: DataFrame,
    *,
    positives: int = 2000,
    negatives: int = 4000,
    longest: int = 20_000,
    seed: int = 1,
) -> Network:
    """Train in memory on a bounded sample of labelled documents (doc_id, text, lang); see fit().

    The sample has at most so many documents of either label, drawn by a hash of their ids from
    those with a text up to ``longest`` characters; each stands for its share of all labelled
    documents. Of a document's texts the one with the smallest hash counts. Contradicting labels
    of a document count as toxic, null ones not at all.
    """
    spark = docs.sparkSession
    batches(spark, 1024)
    marked = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")
    )
    counts = {r.toxic: r["count"] for r in marked.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    lot = F.xxhash64(F.lit(seed), "doc_id")
    short = docs.filter(F.length("text") <= longest).select("doc_id", "text", "lang")
    usable = cut(marked.join(short.select("doc_id").distinct(), "doc_id", "left_semi"))
    drawn = [
        usable.filter(label).orderBy(lot, "doc_id").limit(most)
        for label, most in ((F.col("toxic") > 0, positives), (F.col("toxic") <= 0, negatives))
    ]
    # At most positives + negatives rows: small by construction.
    sample = F.broadcast(drawn[0].union(drawn[1]))
    one = F.min(F.struct(F.xxhash64("text", "lang").alias("hash"), "text", "lang")).alias("one")
    single = short.join(sample, "doc_id").groupBy("doc_id").agg(F.first("toxic").alias("toxic"), one)
    rows = single.select("doc_id", "toxic", "one.text", "one.lang").toPandas().sort_values("doc_id")
    target = (rows["toxic"].to_numpy(int) > 0).astype(float)
    importance = np.ones(len(rows))
    for label in (False, True):
        there = (target > 0) == label
        importance[there] = counts.get(label, 0) / max(int(there.sum()), 1)
    return train(rows["text"].tolist(), target, importance, rows["lang"].tolist())


# --- training where the texts are ------------------------------------------------------

_BLOCK_WORDS = 4_000_000
_STEP_WORDS = 200_000  # words of a step, or one text
_FINE = 1 << 20  # sums of whole numbers do not depend on their order
_BINS = 256  # bins of a logit's unit
_ENCODED = (
    "buckets binary, codes binary, starts binary, target binary, weight binary, aside binary, lang array<string>"
)
_MOVED = ["bucket", "w", "s", *[f"d{i}" for i in range(8)]]


def _encoded(most: int):
    """A row for each block of documents: buckets of its words, texts as numbers of words, labels."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            target, weight, aside, lang = (pa.concat_arrays(c) for c in zip(*marks))
            blobs = (
                np.array(lexicon.rows, np.int32), np.concatenate(codes), np.array(starts, np.int64),
                target.to_numpy(), weight.to_numpy(), aside.to_numpy(),
            )
            columns = [pa.array([b.tobytes()], pa.binary()) for b in blobs] + [pa.array([lang.to_pylist()])]
            names = [n.split()[0] for n in _ENCODED.split(", ")]
            return pa.RecordBatch.from_arrays(columns[:-1] + [columns[-1].cast(pa.list_(pa.string()))], names=names)

        lexicon, codes, starts, marks, size = _Lexicon(), [], [], [], 0
        for part in parts:
            for i in range(part.num_rows):
                slots, _ = _flat([part.column(0)[i].as_py() or ""], lexicon)
                codes.append(slots.astype(np.int32))
                starts.append(size)
                marks.append([c.slice(i, 1) for c in part.columns[1:]])
                size += len(slots)
                if len(codes) >= most or size >= _BLOCK_WORDS:
                    yield row()
                    lexicon, codes, starts, marks, size = _Lexicon(), [], [], [], 0
        if codes:
            yield row()

    return run


class _Block:
    """Documents of an encoded row; ``near`` are the block's known buckets, the first one none."""

    def __init__(self, part: pa.RecordBatch, i: int, known: np.ndarray | None = None):
        kinds = (np.int32, np.int32, np.int64, np.float64, np.float64, np.int32)
        found = [np.frombuffer(c[i].as_buffer(), k) for c, k in zip(part.columns, kinds)]
        buckets, self.codes, self.starts, self.target, self.weight, self.aside = found
        self.buckets = buckets.reshape(-1, 1 + len(_STEMS))
        self.lang = part.column(6)[i]
        self.ends = np.append(self.starts[1:], len(self.codes))
        if known is not None:
            near, rows = np.unique(np.where(known[self.buckets], self.buckets, 0), return_inverse=True)
            # Padding has bucket 0, so that this is always the first.
            self.near, self.rows = near, rows.reshape(self.buckets.shape)

    def batches(self, chosen: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Documents, their words and where each begins, at most so many documents at a time."""
        held, size = [], 0
        for i in chosen.tolist():
            words = int(self.ends[i] - self.starts[i])
            if held and (len(held) == most or size + words > _STEP_WORDS):
                yield self.together(held)
                held, size = [], 0
            held.append(i)
            size += words
        if held:
            yield self.together(held)

    def together(self, held: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [self.codes[self.starts[i] : self.ends[i]] for i in held]
        starts = np.cumsum([0, *[len(p) for p in parts[:-1]]])
        return np.array(held), np.concatenate(parts).astype(np.int64), starts


def _blocks(parts: Iterator[pa.RecordBatch], known: np.ndarray | None = None) -> Iterator[_Block]:
    for part in parts:
        for i in range(part.num_rows):
            yield _Block(part, i, known)


def _met(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of a block a bucket is."""
    for block in _blocks(parts):
        seen = np.zeros(BUCKETS, np.int32)
        for a, b in zip(block.starts.tolist(), block.ends.tolist()):
            seen[np.unique(block.buckets[np.unique(block.codes[a:b])])] += 1
        buckets = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(buckets.astype(np.int32)), pa.array(seen[buckets])], names=["bucket", "n"]
        )


def _moved(model, epoch: int, batch: int, balance: tuple[float, float]):
    """How far the documents of each block move the network, beginning from the common one."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, embedded, dense = model.value
        before = common.dense()
        for block in _blocks(parts, common.known):
            fit = np.flatnonzero(block.aside == 0)
            if not len(fit):
                continue
            net = replace(
                common, embedding=common.embedding[block.near], _memory=None,
                filters=dict(common.filters), bias=dict(common.bias),
            )
            start = net.embedding.copy()
            pace = np.repeat(embedded[block.near][:, None], start.shape[1], axis=1)
            speed = {"embedding": pace.copy(), **net.named(dense)}
            np.random.default_rng((3, epoch)).shuffle(fit)
            importance = block.weight * np.where(block.target > 0, *balance)
            rate = 0.1 / (1 + epoch / 2)
            for chosen, slots, starts in block.batches(fit, batch):
                net.learn(slots, starts, block.rows, block.target[chosen], importance[chosen], speed, rate)
            weight = len(fit)
            gone, paces = net.embedding - start, (speed["embedding"] - pace).mean(axis=1)
            touched = np.flatnonzero((paces > 0) & (block.near > 0))
            ids = np.concatenate((block.near[touched], -1 - np.arange(len(before))))
            steps = np.zeros((len(ids), 8))
            steps[: len(touched)] = gone[touched]
            steps[len(touched) :, 0] = net.dense() - before
            faster = np.concatenate((paces[touched], net.flat(speed) - dense))
            whole = np.rint(np.column_stack((faster, steps)) * (weight * _FINE)).astype(np.int64)
            columns = [ids.astype(np.int64), np.full(len(ids), weight, np.int64), *whole.T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=_MOVED)

    return run


def _judged(model, every: bool):
    """Logits of the documents left out of training, or of every one, in bins."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = model.value
        for block in _blocks(parts, common.known):
            wanted = np.flatnonzero((block.aside > 0) | every)
            net = replace(common, embedding=common.embedding[block.near], _memory=None)
            known = net.embedding[block.rows].sum(axis=1)
            for chosen, slots, starts in block.batches(wanted, 1024):
                logits = net.pooled(known[slots], starts).astype(float)
                bins = np.rint(np.clip(logits, -1000, 1000) * _BINS).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [block.lang.values.take(pa.array(chosen)), *map(pa.array, (
                        block.target[chosen] > 0, bins, np.rint(block.weight[chosen] * _FINE).astype(np.int64),
                    ))], names=["lang", "toxic", "bin", "w"],
                )

    return run


def _learned(
    labelled: DataFrame,
    block: int = 8192,
    *,
    batch: int = 32,
    least_documents: int = 3,
    least_positives: int = 20,
) -> Network:
    """Train on all rows (text, toxic, weight, aside, lang), where they are.

    In each round every block, of at most so many documents, trains from the common network, and the moves are
    averaged: of a bucket over the blocks that move it, of the rest over all. Only these sums, as
    large as the network, come to the driver. Many documents take three rounds, few up to six.
    """
    spark = labelled.sparkSession
    context = spark.sparkContext
    blocks = stored(labelled.mapInArrow(_encoded(block), _ENCODED), "toxicity")
    met = blocks.mapInArrow(_met, "bucket int, n int").groupBy("bucket").agg(F.sum("n").alias("n"))
    often = met.filter(F.col("n") >= least_documents).select("bucket").toArrow()["bucket"].to_numpy()
    known = np.zeros(BUCKETS, bool)
    known[often] = True
    known[0] = False
    toxic, weight, aside = (F.col(c) for c in ("toxic", "weight", "aside"))
    sums = {
        (r.toxic, r.aside): (r.w, r.n)
        for r in labelled.groupBy((toxic > 0).alias("toxic"), (aside > 0).alias("aside"))
        .agg(F.sum(F.round(weight * _FINE).cast("long")).alias("w"), F.count("*").alias("n"))
        .collect()
    }

    def of(kind: bool, sides=(False, True), which: int = 0) -> float:
        return sum(sums.get((kind, side), (0, 0))[which] / (1 if which else _FINE) for side in sides)

    hits, others = of(True), of(False)
    net = Network.fresh(known, (hits + 0.5) / (hits + others + 10))
    if not hits or not others:
        net.thresholds = {None: 0.5}
        net.weight[:] = 0
        return net
    share = of(True, (False,)) / max(of(True, (False,)) + of(False, (False,)), 1e-9)
    balance = 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)
    net.offset = 0.0
    embedded = np.full(BUCKETS, 1e-8, np.float32)
    dense = np.full(len(net.dense()), 1e-8)
    rows = of(True, (False,), 1) + of(False, (False,), 1)
    rounds = int(min(max(_STEPS // max(rows, 1), 3), 6))
    schema = ", ".join(f"{c} long" for c in _MOVED)
    for epoch in range(rounds):
        model = context.broadcast((net, embedded, dense))
        moves = blocks.mapInArrow(_moved(model, epoch, batch, balance), schema)
        summed = moves.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in _MOVED[1:]])
        parts = [(F.col(c) / F.col("w") / _FINE).cast("float").alias(c) for c in _MOVED[2:]]
        found = summed.select(F.col("bucket").cast("int"), *parts).toArrow()
        model.destroy()
        bucket = found["bucket"].to_numpy()
        faster, *steps = (found[c].to_numpy() for c in _MOVED[2:])
        words, at = np.flatnonzero(bucket > 0), np.flatnonzero(bucket < 0)
        net.embedding[bucket[words]] += np.stack(steps, axis=1)[words]
        embedded[bucket[words]] += faster[words]
        after = net.dense()
        after[-1 - bucket[at]] += steps[0][at]
        dense[-1 - bucket[at]] += faster[at]
        net.settle(after)

    # The model and its thresholds are checked on the fifth left out, if that has both labels.
    model = context.broadcast(net)
    both = all(of(kind, (True,)) for kind in (False, True))
    judged = blocks.mapInArrow(_judged(model, not both), "lang string, toxic boolean, bin long, w long")
    binned = cut(judged.groupBy("lang", "toxic", "bin").agg(F.sum("w").alias("w"), F.count("*").alias("n")))
    model.destroy()

    def arrays(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = sorted(rows, key=lambda r: (r.bin, r.toxic))
        columns = [[r.bin / _BINS for r in rows], [r.toxic for r in rows], [r.w / _FINE for r in rows]]
        return tuple(np.array(c, float) for c in columns)

    logits, target, importance = arrays(binned.groupBy("bin", "toxic").agg(F.sum("w").alias("w")).collect())
    net.scale, net.shift = _calibrate(logits, target, importance)

    def chances(logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(net.scale * logits + net.shift, -60, 60)))

    net.thresholds = {None: _threshold(chances(logits), target, importance)}
    toxic = F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0))
    clean = F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n")))
    spoken = binned.filter("lang != ''").groupBy("lang").agg(toxic.alias("toxic"), clean.alias("clean"))
    enough = F.least("toxic", "clean") >= least_positives
    own: dict[str, list] = {}
    for r in binned.join(spoken.filter(enough).select("lang"), "lang", "left_semi").collect():
        own.setdefault(r.lang, []).append(r)
    for lang in sorted(own):
        logits, target, importance = arrays(own[lang])
        net.thresholds[lang] = _threshold(chances(logits), target, importance)
    return net


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    positives: int | None = None,
    negatives: int | None = None,
    longest: int | None = None,
    seed: int = 1,
) -> Network:
    """Train on all labelled documents (doc_id, text, lang) with labels (doc_id, toxic).

    Whole texts of all labelled rows train; rows that repeat a document share its weight. A fifth of
    the documents, drawn by a hash of their ids, is left out for calibration and thresholds.
    Contradicting labels of a document count as toxic, null ones not at all. A null text is empty.

    With ``positives`` and ``negatives`` a sample is drawn instead, see fit_sample().
    """
    if positives is not None and negatives is not None:
        bound = {} if longest is None else {"longest": longest}
        return fit_sample(docs, labels, positives=positives, negatives=negatives, seed=seed, **bound)
    spark = docs.sparkSession
    batches(spark, 1024)
    if longest is not None:
        docs = docs.filter(F.length("text") <= longest)
    marked = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")
    )
    # Ids only; the texts are joined once it is known how often each is there.
    there = cut(docs.select("doc_id").groupBy("doc_id").agg(F.count("*").alias("rows")).join(marked, "doc_id"))
    rows = there.agg(F.sum("rows")).first()[0] or 0
    fifth = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(5)) == 0
    labelled = docs.select("doc_id", "text", "lang").join(there, "doc_id").select(
        "text",
        (F.col("toxic") > 0).cast("double").alias("toxic"),
        (1 / F.col("rows")).alias("weight"),
        fifth.cast("int").alias("aside"),
        "lang",
    )
    # Small blocks would move the network by few steps only.
    return _learned(labelled.coalesce(max(rows // 4000, 1)))


def score_column(text: Column, model) -> Column:
    """Calibrated chance that the text is toxic; null counts as empty. ``model`` is a broadcast."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.value.scores([t or "" for t in texts]), dtype="float64")

    return of(text)


def score(docs: DataFrame, network: Network, *, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """The documents with ``score`` and ``flagged``, by the threshold of their language.

    Null and empty texts have the score of a text without any known word; repeated rows score
    alike. The language decides about the threshold only. A model without labels scores its
    prior. Input columns with these names are replaced.
    """
    spark = docs.sparkSession
    batches(spark, 1024)
    model = spark.sparkContext.broadcast(network)
    scored = own_names(docs, score=score_column(F.col(f"`{text}`"), model))
    common = F.lit(network.thresholds[None])
    own = [(k, v) for k, v in network.thresholds.items() if k is not None]
    limit = common
    for spoken, value in own if lang else []:
        limit = F.when(F.col(f"`{lang}`") == spoken, F.lit(value)).otherwise(limit)
    return own_names(scored, flagged=F.col("score") >= limit)
