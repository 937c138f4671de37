"""Personal data by weak supervision.

Strict patterns give the base spans, which always stay. Looser patterns propose further spans.
Every proposed or base span gets votes (for, against, none) from labelling functions of three
sorts: regular expressions and checksums, gazetteers, context. Expectation maximisation over the
counts of vote patterns estimates how reliable each function is, without labels; the resulting
posteriors train a logistic span classifier on shape and context, which decides about the
proposed spans.

Vote patterns are counted by Spark and are few however large the corpus: their number is bounded
by the kinds and functions. The classifier is fitted on a sample of at most ``sample`` spans,
chosen by hash. Nothing is shuffled but span rows; texts stay where they are.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, cut, own_names, shielded, with_text

BASE = ("email", "ip", "card", "phone")
ADDED = ("name", "ssn", "iban", "secret")
KINDS = BASE + ADDED

# --- base spans (fixed patterns) -------------------------------------------------------

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# A match can begin only where a run of digits does, and backing out of a run never helps.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local@domain, found from each @ outwards in linear time."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for match in _IP.finditer(text):
        parts = [p.lstrip("0") for p in match.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield match.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = _digits(match.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 9 <= len(_digits(match.group())) <= 15:
            yield match.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    found = [("email", *s) for s in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", *s) for s in _ips(text)] if "." in text else []
        found += [("card", *s) for s in _cards(text)]
        found += [("phone", *s) for s in _phones(text)] if "+" in text else []
    return found


# --- proposed spans --------------------------------------------------------------------

_TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Señor", "Señora")
_PROPOSALS = (
    ("email", " dot ", re.compile(
        r"(?<![\w.%+-])[\w.%+-]{1,64} (?:at|\(at\)|\[at\]) [\w-]{1,63}(?: dot [\w-]{2,63}){1,4}")),
    ("email", "dot", re.compile(
        r"(?<![\w.%+-])[\w.%+-]{1,64} ?[(\[]at[)\]] ?[\w-]{1,63}"
        r"(?: ?[(\[]dot[)\]] ?[\w-]{2,63}){1,4}")),
    ("phone", None, re.compile(
        r"(?<![\w+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])")),
    ("phone", "00", re.compile(r"(?<![\w+.-])00[1-9][0-9 ]{8,14}[0-9](?![\w-])")),
    ("ssn", "-", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")),
    ("iban", None, re.compile(
        r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    # Whole runs, however long; those without a digit are left out below.
    ("secret", None, re.compile(r"(?<![\w-])[\w-]{16,}+")),
)
_NAME = re.compile(rf"(?<!\w)(?:{'|'.join(_TITLES)})\.? ([A-Z][\w'-]+(?: [A-Z][\w'-]+)?)")
_NAMED = re.compile(r"(?i:my name is|je m'appelle|ich heiße|me llamo) ([A-Z][\w'-]+(?: [A-Z][\w'-]+)?)")
_NAME_CUES = tuple(f"{t}{end}" for t in _TITLES for end in (". ", " "))
# In lower case, of letters that no other letter equals when case is ignored.
_NAMED_CUES = ("y name ", "appelle", "ch he", "llamo")


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Loose spans, first come first served where they overlap."""
    found = []
    if _DIGIT.search(text):
        for kind, needs, pattern in _PROPOSALS[2:]:
            if needs is None or needs in text:
                found += [
                    (kind, *m.span())
                    for m in pattern.finditer(text)
                    if kind != "secret" or _DIGIT.search(m.group())
                ]
    for kind, needs, pattern in _PROPOSALS[:2]:
        if needs in text and "at" in text:
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
    if any(cue in text for cue in _NAME_CUES):
        found += [("name", *m.span(1)) for m in _NAME.finditer(text)]
    low = text.lower()
    if any(cue in low for cue in _NAMED_CUES):
        found += [("name", *m.span(1)) for m in _NAMED.finditer(text)]
    return found


def spans_of(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and the proposals that touch neither these nor each other."""
    base = base_spans(text)
    proposed = proposals(text)
    if not proposed:
        return base, []
    ends: list[tuple[int, int]] = sorted((a, b) for _, a, b in base)
    free, at, last = [], 0, -1
    for kind, a, b in sorted(proposed, key=lambda s: (s[1], -s[2])):
        while at < len(ends) and ends[at][1] <= a:
            at += 1
        if a >= last and not (at < len(ends) and ends[at][0] < b):
            free.append((kind, a, b))
            last = b
    return base, sorted(free, key=lambda s: (KINDS.index(s[0]), s[1]))


# --- votes -----------------------------------------------------------------------------

DOMAINS = set("com org net edu gov info io de fr es uk it eu us ca ch at nl be".split())
FIRST_NAMES = set(
    "james mary john robert michael linda david maria anna peter paul laura thomas hans"
    " klaus jürgen sabine pierre jean marie claire luc carlos josé juan ana lucía miguel"
    " carmen sofia emma lukas felix sarah daniel julia".split()
)
CUES = {
    "email": "mail contact write reach".split(),
    "ip": "ip host server address from login".split(),
    "card": "card visa mastercard credit payment amex".split(),
    "phone": "phone call tel mobile fax contact dial".split(),
    "name": "name dear signed contact patient customer".split(),
    "ssn": "ssn social security".split(),
    "iban": "iban account bank konto compte cuenta".split(),
    "secret": "token key secret password passwd api auth bearer".split(),
}
AGAINST = "version isbn issn order page chapter figure section total price usd eur $ €".split()
_IBAN_SIZES = range(15, 35)


def _checksum(kind: str, text: str) -> int:
    if kind == "card":
        return 1 if luhn(_digits(text)) else -1
    if kind == "iban":
        plain = text.replace(" ", "")
        moved = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
        return 1 if len(plain) in _IBAN_SIZES and int(moved) % 97 == 1 else -1
    if kind == "ssn":
        area, group, serial = text.split("-")
        return -1 if area in ("000", "666") or area[0] == "9" or "00" == group or "0000" == serial else 1
    return 0


def _format(kind: str, text: str, base: bool) -> int:
    if base:
        return 1
    if kind == "secret":
        digits = len(_DIGIT.findall(text))
        return 1 if digits >= 4 and len(text) - digits >= 4 and len(set(text)) >= 10 else -1
    return 1 if kind in ("ssn", "iban", "phone") else 0


def _gazetteer(kind: str, text: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[^a-z]+", text.lower())[-1] in DOMAINS else -1
    if kind == "card":
        return 1 if _digits(text)[:1] in "3456" else -1
    if kind == "name":
        return 1 if text.split()[0].lower() in FIRST_NAMES else 0
    if kind == "secret":
        return 1 if text.startswith(("sk_", "sk-", "pk_", "ghp_", "AKIA", "xox")) else 0
    return 0


def _context(kind: str, near: str) -> int:
    near = near.lower()
    if any(w in near for w in CUES[kind]):
        return 1
    return -1 if any(w in near for w in AGAINST) else 0


def _variety(text: str) -> int:
    """Against runs of one character, as fillers have."""
    solid = [c for c in text if c.isalnum()]
    return -1 if len(set(solid)) <= 2 else 1


def votes(text: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """What each labelling function says about a span: 1, 0 or -1."""
    span = text[start:end]
    edge = text[max(0, start - 1) : start] + text[end : end + 1]
    return (
        _format(kind, span, base),
        _checksum(kind, span),
        _gazetteer(kind, span),
        _context(kind, text[max(0, start - 24) : start]),
        _context(kind, text[end : end + 16]),
        -1 if any(c.isalnum() or c in "_@=/" for c in edge) else 1,
        _variety(span),
    )


FUNCTIONS = 7


@dataclass(frozen=True)
class Reliability:
    """Class prior, and for each class and function the chances of the votes -1, 0, 1."""

    prior: float
    chance: np.ndarray  # [class, function, vote + 1]

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance that spans with these votes (rows) are personal data."""
        at = np.arange(patterns.shape[1])
        logs = np.log(self.chance[:, at, patterns + 1]).sum(axis=2)
        logs += np.log([[1 - self.prior], [self.prior]])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> Reliability:
    """Expectation maximisation over distinct vote patterns, from the majority vote."""
    total = patterns.sum(axis=1)
    belief = 1 / (1 + np.exp(-total.astype(float)))
    for _ in range(rounds):
        prior = float(np.clip((belief * counts).sum() / max(counts.sum(), 1), 0.01, 0.99))
        chance = np.empty((2, patterns.shape[1], 3))
        for c, weight in enumerate(((1 - belief) * counts, belief * counts)):
            for v in (-1, 0, 1):
                hits = ((patterns == v) * weight[:, None]).sum(axis=0)
                chance[c, :, v + 1] = (hits + 1) / (weight.sum() + 3)
        found = Reliability(prior, chance)
        belief = found.posterior(patterns)
    return found


# --- classifier ------------------------------------------------------------------------

BUCKETS = 1 << 12


def features(text: str, kind: str, start: int, end: int) -> list[int]:
    """Hashed shape and context of a span."""
    span = text[start:end]
    shape = re.sub(r"[A-Z]", "A", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "0", span)))
    short = re.sub(r"(.)\1+", r"\1+", shape)
    left, right = text[max(0, start - 24) : start], text[end : end + 16]
    named = [
        f"kind={kind}", f"shape={kind}:{short}", f"size={kind}:{min(len(span), 40) // 3}",
        f"check={kind}:{_checksum(kind, span)}", f"gazetteer={kind}:{_gazetteer(kind, span)}",
        f"format={kind}:{_format(kind, span, False)}",
        f"left={kind}:{_context(kind, left)}", f"right={kind}:{_context(kind, right)}",
        f"edge={left[-1:].isalnum()}{right[:1].isalnum()}", f"varied={_variety(span)}",
        *[f"word={w}" for w in left.lower().split()[-2:]],
    ]
    return [zlib.crc32(f.encode()) % BUCKETS for f in named]


def train(rows: list[list[int]], target: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weights of a logistic regression on hashed features and soft targets."""
    weight = np.zeros(BUCKETS)
    if not rows:
        return weight
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.concatenate([np.array(r) for r in rows])
    speed = np.full(BUCKETS, 1e-8)
    for _ in range(rounds):
        score = np.bincount(at, weight[feature], len(rows))
        error = 1 / (1 + np.exp(-score)) - target
        slope = np.bincount(feature, error[at], BUCKETS) / len(rows) + 1e-4 * weight
        speed += slope * slope
        weight -= 0.5 * slope / np.sqrt(speed)
    return weight


@dataclass(frozen=True)
class Model:
    reliability: Reliability
    weight: np.ndarray
    threshold: float

    def accepts(self, text: str, kind: str, start: int, end: int) -> bool:
        score = self.weight[features(text, kind, start, end)].sum()
        return 1 / (1 + np.exp(-score)) >= self.threshold

    def spans(self, text: str):
        """Base spans, and all spans."""
        base, proposed = spans_of(text)
        if not proposed:
            return base, base
        more = [s for s in proposed if self.accepts(text, *s)]
        return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1]))


# --- operator --------------------------------------------------------------------------


def _text(data: bytes | None) -> str:
    return (data or b"").decode("utf-8", "replace")


def _voted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for text in map(_text, frame.iloc[:, 0]):
            base, proposed = spans_of(text)
            for kind, a, b, strict in [(*s, True) for s in base] + [(*s, False) for s in proposed]:
                around = text[max(0, a - 24) : b + 16]
                out.append((
                    ",".join(map(str, votes(text, kind, a, b, strict))),
                    features(text, kind, a, b),
                    zlib.crc32(f"{kind}:{a}:{around}".encode()),
                ))
        yield pd.DataFrame(out, columns=["votes", "features", "lot"])


def fit(docs: DataFrame, *, text: str = "text", sample: int = 20_000, threshold: float = 0.8) -> Model:
    """Estimate the reliabilities from all spans and train the classifier on a sample.

    ``sample`` bounds the spans the classifier is fitted on; lots drawn from the spans' own
    text choose them, so that runs agree. Without any span the model accepts nothing.
    """
    batches(docs.sparkSession, 1024)
    bodies = docs.select(F.col(f"`{text}`").cast("binary").alias("body"))
    voted = cut(bodies.mapInPandas(_voted, "votes string, features array<int>, lot long"))
    counted = voted.groupBy("votes").count().orderBy("votes").collect()
    patterns = np.array([list(map(int, r.votes.split(","))) for r in counted], np.int64)
    patterns = patterns.reshape(-1, FUNCTIONS)
    reliability = estimate(patterns, np.array([r["count"] for r in counted], float))
    belief = dict(zip((r.votes for r in counted), reliability.posterior(patterns)))
    rows = voted.orderBy("lot", "votes", "features").limit(sample).collect()
    weight = train([list(r.features) for r in rows], np.array([belief[r.votes] for r in rows]))
    return Model(reliability, weight, threshold)


def _joined(spans) -> str:
    return ",".join([f"{kind}:{a}:{b}" for kind, a, b in spans])


def _found(model: Model, bodies: pd.Series) -> pd.DataFrame:
    pairs = [tuple(map(_joined, model.spans(_text(body)))) for body in bodies]
    return pd.DataFrame(pairs, columns=["base", "spans"])


def _redacted(model: Model, bodies: pd.Series) -> pd.Series:
    def redact(text: str) -> str:
        out, free = [], 0
        for kind, a, b in sorted(model.spans(text)[1], key=lambda s: (s[1], -s[2])):
            if a >= free:
                out += [text[free:a], f"[{kind.upper()}]"]
            free = max(free, b)
        return "".join([*out, text[free:]]) if out else text

    return pd.Series([None if b is None else redact(_text(b)) for b in bodies], dtype=object)


def _column(text: Column, function, model: Model, returns: str) -> Column:
    def of(bodies: pd.Series) -> pd.Series:
        return function(model, bodies)

    def of_struct(bodies: pd.Series) -> pd.DataFrame:
        return function(model, bodies)

    chosen = of_struct if returns.startswith("struct") else of
    return F.pandas_udf(chosen, returns)(text.cast("binary"))


def find(docs: DataFrame, *, text: str = "text", model: Model | None = None, **fitting) -> DataFrame:
    """The documents with their spans.

    Added: ``base`` and ``spans`` (kind:start:end in code points, end exclusive, by kind, then
    start, joined by commas) and for each base kind its number of base spans, ``n_email`` to
    ``n_phone``. Null and empty texts have no spans; repeated rows have the same. Bytes that are
    not UTF-8 count as replacement characters. Input columns with these names are replaced.
    """
    model = model or fit(docs, text=text, **fitting)
    batches(docs.sparkSession, 1024)
    found = _column(F.col(f"`{text}`"), _found, model, "struct<base string, spans string>")
    spread = own_names(docs, _found=found)
    spread = own_names(spread, base=F.col("_found.base"), spans=F.col("_found.spans")).drop("_found")
    counts = {
        f"n_{kind}": F.regexp_count("base", F.lit(f"(^|,){kind}:")).cast("long") for kind in BASE
    }
    return own_names(spread, **counts)


def redact(docs: DataFrame, *, text: str = "text", model: Model | None = None, **fitting) -> DataFrame:
    """The documents with each span replaced by its kind in brackets, as in [EMAIL].

    Where spans overlap, the first one names the replacement. ``n_chars``, where there is one,
    follows the text. Null texts stay null.
    """
    model = model or fit(docs, text=text, **fitting)
    batches(docs.sparkSession, 1024)
    inner, name = shielded(docs)
    clean = _column(F.col(name[text]), _redacted, model, "string")
    return with_text(inner.withColumn("_text", clean), name, text, F.col("_text"))
