import re
from collections import Counter

import pytest

from tidewatch.llm import quality

from .helpers import ODD_TEXTS, documents, table_rows

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


@pytest.mark.parametrize("kind", ["table", "odd"])
def test_base_counts(spark, sf_dir, kind):
    texts = [r["text"] for r in table_rows(sf_dir, "documents")] if kind == "table" else ODD_TEXTS
    rows = quality.assess(documents(spark, list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in COUNTS) == plain(texts[r.doc_id]), r.doc_id


def prose(n, start=0):
    words = "One plain line says what no other does".split()
    return [" ".join(f"{w}{i}" for w in words) + "." for i in range(start, start + n)]


def test_lines_that_break_a_rule_go_and_the_document_stays(spark):
    junk = [
        "Home", "Products | News | Jobs | Contact", "BUY!! NOW!! BUY!! MORE!!",
        "word### word$$$ word&&&", "Copyright (c) somebody. All rights reserved.",
    ]
    text = "\n".join([*prose(6), *junk, "", *prose(6, 6)])
    row = quality.assess(documents(spark, [(1, text)])).first()
    assert row.kept and row.cleaned == "\n".join([*prose(6), "", *prose(6, 6)])
    assert 0 < row.lost < 0.5


def test_clean_documents_stay_whole(spark):
    texts = ["\n".join(prose(8)), " ".join(prose(8)), "\n\n".join(prose(8)) + "\n", "¡Sí! " + " ".join(prose(8))]
    rows = quality.assess(documents(spark, list(enumerate(texts)))).collect()
    assert all(r.kept and r.cleaned == texts[r.doc_id] and r.lost == 0 for r in rows)


def test_a_document_that_loses_too_much_is_rejected(spark):
    menu = [f"Item{i} | Entry{i} | Other{i} | Thing{i} | More{i} | Even{i}" for i in range(30)]
    row = quality.assess(documents(spark, [(1, "\n".join([*prose(5), *menu]))])).first()
    assert not row.base_failed and row.lost > 0.5 and not row.kept


def test_clean_keeps_columns_and_follows_the_length(spark):
    text = "\n".join([*prose(8), "Log in"])
    docs = documents(spark, [(1, text, "en", "s", 5), (2, "short"), (None, None)])
    docs = docs.selectExpr("*", "1 AS n_words", "'x' AS kept", "2 AS _text", "3 AS cleaned")
    out = quality.clean(docs)
    assert out.dtypes == docs.dtypes
    (row,) = out.collect()
    assert row.text == "\n".join(prose(8)) and row.n_chars == len(row.text)
    assert (row.n_words, row.kept, row["_text"], row.cleaned) == (1, "x", 2, 3)


def test_empty_table_and_clashing_names(spark):
    assert quality.assess(documents(spark, [])).collect() == []
    docs = documents(spark, [(1, "x")]).selectExpr("*", "9 AS N_Words", "8 AS _lines", "7 AS lost")
    out = quality.assess(docs)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert out.first()["n_words"] == 1


def test_plan_has_no_python_and_no_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = quality.assess(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_a_filter_does_not_repeat_the_work_inside_loops(spark):
    """As many words as a text may have; splitting it anew for each of them would never end."""
    texts = [" ".join(f"word{i}" for i in range(40_000)), *ODD_TEXTS]
    docs = documents(spark, list(enumerate(texts)))
    assert [r.doc_id for r in quality.clean(docs).collect()] == [0]


def test_indented_menu_entries_fail(spark):
    lines = [*prose(8), " " * 40 + "Home", "search" + " " * 30, " " * 30 + "no entry of a menu"]
    row = quality.assess(documents(spark, [(1, "\n".join(lines))])).first()
    assert row.cleaned.split("\n") == [*prose(8), lines[-1]]


@pytest.mark.parametrize("entry", ["\tHome", "Home\r", " \t\x0bHome\x0c\r", "  HOME  "])
def test_menu_entries_fail_between_any_word_breaks(spark, entry):
    text = "\n".join([*prose(8), entry, *prose(2, 20)])
    row = quality.clean(documents(spark, [(1, text)])).first()
    assert row.text == "\n".join([*prose(8), *prose(2, 20)])
