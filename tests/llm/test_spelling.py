import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import ODD_TEXTS, documents, table_rows
from tidewatch.llm import spelling


def near(words):
    """Words one edit apart, by what is left of them without one letter."""
    out, rest = defaultdict(set), defaultdict(set)
    for word in words:
        for i in range(len(word)):
            shorter = word[:i] + word[i + 1:]
            rest[shorter, i].add(word)
            if shorter in words:
                out[word].add(shorter)
                out[shorter].add(word)
    for group in rest.values():
        for word in group:
            out[word] |= group - {word}
    return out


def plain(words):
    """Rows (word, form, root, n, n_near, form_n) of a dictionary of counts."""
    beside, rows = near(words), []

    def form(word):
        best = min(beside[word], key=lambda w: (-words[w], w), default=None)
        return best if best and words[best] >= 10 * words[word] else None

    for word, n in words.items():
        root = word
        while form(root):
            root = form(root)
        rows.append((word, form(word), root, n, len(beside[word]), words.get(form(word))))
    return sorted(rows, key=str)


def counts(rows):
    """The words of documents, one in 31 of them short of a letter."""
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            out[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def whole(docs):
    return spelling.variants(spelling.counted(spelling.misspelled(spelling.runs(docs))))


def test_documents_equal_a_plain_version(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table_rows(sf_dir, "documents")]
    rows += [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "colours colours Ünïcödé") for _ in "ab"]
    got = found(whole(documents(spark, rows)))
    assert got == plain(counts(rows))
    assert any(r[1] for r in got)


@pytest.mark.parametrize("parts", [{}, {"replaced": 3, "inserted": 2}, {"replaced": 6, "inserted": 3}])
def test_dense_words_and_chains(spark, parts):
    """Few letters, so that many words are made of the same ones; counts that make chains."""
    rnd = random.Random(8)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 6))): 10 ** rnd.randint(0, 6)
             for _ in range(400)}
    words |= {"x" * 30_000: 5, "x" * 29_999 + "y": 50, "x" * 29_999: 500}
    got = found(spelling.variants(frame(spark, words), **parts))
    assert got == plain(words)
    assert any(r[1] != r[2] and r[1] for r in got)


def test_ties_go_to_the_first_word(spark):
    words = {"abcdefg": 2, "abcdefé": 40, "abcdefh": 40, "bbcdefg": 40}
    got = {r[0]: r for r in found(spelling.variants(frame(spark, words)))}
    assert got["abcdefg"] == ("abcdefg", "abcdefh", "abcdefh", 2, 3, 40)


def test_empty_null_and_repeated_words(spark):
    assert found(spelling.variants(frame(spark, {}))) == []
    rows = [(None, 5), ("", 5), ("abcdefg", 1), ("abcdefg", 2), ("abcdefgh", 30)]
    got = found(spelling.variants(spark.createDataFrame(rows, "word string, n long")))
    assert got == plain({"abcdefg": 3, "abcdefgh": 30})
    assert found(whole(documents(spark, []))) == []
    assert found(whole(documents(spark, [(1, None), (None, None)]))) == []


def test_extra_columns_do_no_harm(spark):
    rows = [(i, "separate seperate separate") for i in range(40)]
    docs = documents(spark, rows)
    clash = docs.selectExpr("*", "1 AS id", "'x' AS run", "'x' AS word", "2 AS n", "3 AS h")
    assert found(whole(clash)) == plain(counts(rows))


def test_near_words_share_a_signature():
    """The join's guarantee, on random edits: replaced, inserted and deleted letters."""
    rnd = random.Random(9)
    tables = [np.array([rnd.randrange(n) for _ in range(1024)]) for n in (4, 2)]
    for table, n in zip(tables, (4, 2)):
        table[:n] = range(n)
    for _ in range(300):
        word = "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 12)))
        at, letter = rnd.randrange(len(word)), rnd.choice("fgh")
        for other in (word[:at] + letter + word[at + 1:], word[:at] + letter + word[at:]):
            keys, kinds = spelling.signatures([word, other], *tables)
            role = (0, 0) if len(word) == len(other) else (1, 2)
            assert set(keys[0][kinds[0] == role[0]]) & set(keys[1][kinds[1] == role[1]])


def test_signatures_are_shuffled_once(spark):
    pairs = spelling.near_pairs(frame(spark, {"abcdefg": 2, "abcdefh": 40}))
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in final
