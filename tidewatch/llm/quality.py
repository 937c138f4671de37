"""Quality rules by line-first cleaning.

Every line is judged on its own (symbols, shouting, navigation, boilerplate); lines that fail
are removed, and a document that loses too much of its text that way is rejected. Built of
column expressions only: each document is judged within its row, so there is no shuffle and
no group that could grow.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BREAKS, own_names, shielded, with_text, words

#: The symbols that are counted.
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
#: A character of a word.
WORD = r"[^\x20\x09-\x0D]"
NAVIGATION = (
    "home", "menu", "next", "previous", "back to top", "read more", "log in", "sign up",
    "skip to content", "share this", "search",
)
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "accept cookies", "uses cookies", "enable javascript", "lorem ipsum",
    "licensed under", "copyright (c)", "©",
)


#: The columns assess() adds.
JUDGED = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "cleaned", "lost",
    "base_failed", "kept",
)


def _any(characters: str) -> str:
    return "[" + "".join("\\" + c if c.isascii() else c for c in characters) + "]"


def line_fails(
    line: Column, max_symbols: float = 0.08, max_shouts: float = 0.08, min_separators: int = 2
) -> Column:
    """Whether a line breaks a rule; a line without words breaks none.

    Punctuation: symbols, or exclamation marks (three or more), make up more than their share of
    the line. Navigation: the line is a menu entry, or separators chop it up (at least
    ``min_separators``, one for every 25 characters). Boilerplate: a known phrase occurs.
    """
    size = F.length(line)

    def count(characters: str) -> Column:
        return F.regexp_count(line, F.lit(_any(characters)))

    return line.rlike(WORD) & (
        (count(SYMBOLS) > max_symbols * size)
        | (count("!") > F.greatest(max_shouts * size, F.lit(2)))
        | (count(SEPARATORS) >= F.greatest(size / 25, F.lit(min_separators)))
        | _is_menu(line)
        | _is_boilerplate(line)
    )


def _is_menu(line: Column) -> Column:
    longest = max(map(len, NAVIGATION))
    entry = F.trim(line, F.lit(BREAKS))
    # Cheap first: no long entry is one of a menu, however far it is indented.
    return (F.length(entry) <= longest) & F.lower(entry).isin(*NAVIGATION)


def _is_boilerplate(text: Column) -> Column:
    """Whether a phrase occurs, in any case."""
    return F.exists(
        F.transform(F.array(F.lower(text)), lambda low: F.forall(
            F.array(*map(F.lit, BOILERPLATE)), lambda phrase: ~F.contains(low, phrase)
        )),
        lambda clear: ~clear,
    )


def _repeat_words(words_: Column) -> Column:
    """Words inside a 3-word window that occurs twice or more."""

    def windows(of) -> Column:
        return F.transform(
            F.slice(words_, F.lit(1), F.greatest(F.size(words_) - 2, F.lit(0))),
            lambda word, at: of(word, F.get(words_, at + 1), F.get(words_, at + 2), at),
        )

    hashes = windows(lambda a, b, c, _: F.xxhash64(a, b, c))
    spelled = windows(lambda a, b, c, at: F.struct(F.concat_ws(" ", a, b, c).alias("w"), at.alias("at")))

    def covered(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda x, at: x["w"].eqNullSafe(F.get(ordered, at + 1)["w"])
            | x["w"].eqNullSafe(F.get(ordered, at - 1)["w"]),
        )
        places = F.transform(twice, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2))
        return F.size(F.array_distinct(F.flatten(places)))

    # Equal windows have equal hashes: where all hashes differ, nothing is spelled out.
    differ = F.exists(F.array(hashes), lambda h: F.size(F.array_distinct(h)) == F.size(h))
    exact = F.get(F.transform(F.array(F.sort_array(spelled)), covered), F.lit(0))
    return F.when(differ, 0).otherwise(exact)


def assess(
    docs: DataFrame,
    *,
    text: str = "text",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_loss: float = 0.5,
) -> DataFrame:
    """The documents with base counts, the cleaned text and the verdict.

    Added columns: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words`` (words inside a 3-word window that occurs twice or more),
    ``base_failed``, ``cleaned`` (the lines that break no rule), ``lost`` (share of word
    characters in removed lines) and ``kept``.

    Null and empty texts count as empty: all counts 0, base_failed, not kept, cleaned ''.
    Repeated rows are judged alike. Input columns with the names above are replaced.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lined = own_names(docs, _text=body, _words=words(body), _lines=F.split(body, "\n", -1))
    # Only texts with a trace of a rule have their lines judged one by one.
    traces = (
        F.col("_text").rlike(_any(SYMBOLS + SEPARATORS + "!"))
        | _is_boilerplate(F.col("_text"))
        | F.exists("_lines", _is_menu)
    )
    good = F.when(traces, F.filter("_lines", lambda line: ~line_fails(line)))
    worded = F.filter("_lines", lambda line: line.rlike(WORD))
    counted = own_names(
        lined.withColumns({"_good": F.coalesce(good, F.col("_lines")), "_worded": worded}),
        n_words=F.size("_words").cast("long"),
        word_chars=F.length(F.array_join("_words", "")).cast("long"),
        n_symbols=F.regexp_count("_text", F.lit(_any(SYMBOLS))).cast("long"),
        n_dup_lines=(F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("long"),
        n_repeat_words=_repeat_words(F.col("_words")).cast("long"),
        cleaned=F.array_join("_good", "\n"),
    )
    left = F.length(F.array_join(words(F.col("cleaned")), ""))
    whole = F.greatest(F.col("word_chars"), F.lit(1))
    marked = own_names(
        counted,
        lost=F.when(F.size("_good") == F.size("_lines"), 0.0).otherwise(1 - left / whole),
        base_failed=(F.col("n_words") < min_words)
        | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")),
    ).drop("_text", "_words", "_lines", "_worded", "_good")
    judged = own_names(marked, kept=~F.col("base_failed") & (F.col("lost") <= max_loss))
    # A filter on what is derived would be pushed below the projections above, which spells
    # the splitting into words out again inside each loop over words. It stops at a generator.
    fixed = F.explode(F.array(F.struct(*JUDGED))).alias("_judged")
    given = [F.col(f"`{c}`") for c in judged.columns if c not in JUDGED]
    return judged.select(*given, fixed).select(*given, *[F.col(f"_judged.{c}") for c in JUDGED])


def clean(docs: DataFrame, *, text: str = "text", **parameters) -> DataFrame:
    """The kept documents with their cleaned text, in the columns they came with.

    ``n_chars``, where there is one, follows the text.
    """
    inner, name = shielded(docs)
    judged = assess(inner, text=name[text], **parameters).filter("kept")
    return with_text(judged, name, text, F.col("cleaned"))
