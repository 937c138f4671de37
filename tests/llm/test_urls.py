import random
import re

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import urls

from .helpers import table_rows


def frame(spark, found):
    return spark.createDataFrame(list(enumerate(found)), "page_id long, url string")


def verdicts(spark, found, **parameters):
    rows = urls.judge(frame(spark, found), **parameters).collect()
    assert len(rows) == len(found)
    return {r.url: r for r in rows}


def plain(url):
    """Host, path and rule as the contract words them."""
    _, there, rest = (url or "").partition("://")
    if not there:
        return "", "", None
    head = re.split(r"[/?#]", rest, maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m.group().lower(), head)
    path = re.split(r"[?#]", rest[len(head) :], maxsplit=1)[0]
    fits = [
        r for r in urls.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return host, path, max(fits, key=lambda r: len(r.name)).name if fits else None


ODD = [
    None, "", "no scheme", "http://", "://x", "http://a.net", "http://A.NET/x?y#z", "http://net/", "http://fornet/x",
    "http://a.example.net/en/", "http://a.example.net/en", "http://example.com/de/1", "http://examplexcom/de/1",
    "http://x.org/fr/?q=1", "http://x.org?fr/", "http://x.org#/fr/", "a://b://c.net/d", "HTTPS://ÄB.Net/É", "x://a\nb/c\nd",
]


@pytest.mark.parametrize("kind", ["table", "odd"])
def test_hosts_paths_and_rules(spark, sf_dir, kind):
    found = [r["url"] for r in table_rows(sf_dir, "pages")] if kind == "table" else ODD
    verdict = {r.name: r.verdict for r in urls.RULES}
    for url, r in verdicts(spark, found).items():
        assert (r.host, r.path, r.rule) == plain(url), url
        if r.rule:
            assert r.verdict == verdict[r.rule]


RULES = [urls.Rule("block", "spam.io", "/ads/bad"), urls.Rule("allow", "spam.io", "/news/")]


def test_templates_of_labelled_branches_spread_to_their_kin(spark):
    labelled = [f"http://spam.io/ads/bad{i}/item/{i}" for i in range(40)]
    labelled += [f"http://spam.io/news/{i}" for i in range(40)]
    # Numbers and names vary, the template is the same.
    kin = ["http://spam.io/ads/offer7/item/99", "http://spam.io/ads/offer8/item/98"]
    other = ["http://spam.io/about", "http://fine.io/ads/offer7/item/99", "http://spam.io/"]
    got = verdicts(spark, [*labelled, *kin, *other], rules=RULES)
    assert all(got[u].verdict == "allow" for u in other[1:2])
    assert got[labelled[0]].verdict == "block" and got[labelled[-1]].verdict == "allow"
    strict = verdicts(spark, [*labelled, *kin, *other], rules=RULES)
    assert strict[labelled[0]].purity > 0.75 > strict[labelled[-1]].purity
    assert strict["http://spam.io/about"].verdict == "allow"
    assert strict["http://fine.io/ads/offer7/item/99"].purity == pytest.approx(0.2)


@pytest.mark.parametrize("n", [31, 32, 33, 300])
def test_the_number_of_siblings_flips_no_verdict(spark, n):
    """Ten blocked pages, and n sections that the labels say nothing about."""
    rules = [urls.Rule("block", "x.io", "/de/")]
    found = [f"http://x.io/de/{i}.html" for i in range(10)]
    open_ = [f"http://x.io/s{chr(97 + i // 26)}{chr(97 + i % 26)}/{i}.html" for i in range(n)]
    got = verdicts(spark, [*found, *open_], rules=rules)
    assert {got[u].verdict for u in open_} == {"allow"}
    assert {got[u].template for u in open_} == {"/<?>/<?>/$"}


def test_few_unlabelled_pages_beside_many_blocked_ones_are_rejected(spark):
    """Templates that no rule fits, on a host whose labels all say block; clean hosts stay."""
    rules = [urls.Rule("block", "spam.io", "/pills/"), urls.Rule("block", "mixed.io", "/pills/"),
             urls.Rule("allow", "mixed.io", "/help/")]
    found = [f"http://{h}.io/pills/{i}" for h in ("spam", "mixed") for i in range(40)]
    found += [f"http://mixed.io/help/{i}" for i in range(40)]
    rest = [f"http://{h}.io/{p}" for h in ("spam", "mixed", "clean") for p in ("order/1", "cart", "")]
    got = verdicts(spark, [*found, *rest], rules=rules)
    for url in rest:
        assert got[url].rule is None
        assert got[url].verdict == ("block" if "spam" in url else "allow"), url


def test_labelled_branches_that_agree_merge(spark):
    names = [f"{a}{b}" for a in "abcdefgh" for b in "stuvwxyz"]
    block = [urls.Rule("block", "h.io", f"/u/{n}/") for n in names[:50]]
    found = [f"http://h.io/u/{n}/p" for n in names]
    got = verdicts(spark, found, rules=block)
    nodes = {n: got[f"http://h.io/u/{n}/p"].template.split("/")[2] for n in names}
    assert {nodes[n] for n in names[:50]} == {"<~>"} and {nodes[n] for n in names[50:]} == {"<?>"}
    assert all(got[f"http://h.io/u/{n}/p"].verdict == "block" for n in names[:50])


@pytest.mark.parametrize("depth", [8, 40])
def test_deep_paths_keep_their_own_purity(spark, depth):
    """What lies below the eighth segment, or the fortieth, is told apart."""
    stem = "http://h.io/" + "/".join("abcdefgh"[i % 8] for i in range(depth))
    rules = [urls.Rule("block", "h.io", f"{stem[11:]}/bad/"), urls.Rule("allow", "h.io", f"{stem[11:]}/good/")]
    found = [f"{stem}/{k}/{i}" for k in ("bad", "good", "other") for i in range(30)]
    got = verdicts(spark, found, rules=rules)
    purity = {u.split("/")[-2]: r.purity for u, r in got.items()}
    assert purity["bad"] > 0.75 > purity["other"] > purity["good"]
    assert {r.template.count("/") for r in got.values()} == {depth + 3}


def plain_tree(labelled):
    """Templates and purities of {(host, segments): (blocked, labelled, unlabelled)}, recursively."""
    out = {}

    def total(shapes):
        return [sum(c[k] for c in shapes.values()) for k in range(3)]

    def pure(counts, parent):
        b, l, u = counts
        return (b + 2 * parent + u * 0.05 * 0.2) / (l + 2 + u * 0.05)

    def descend(shapes, prefix, purity, i):
        children = {}
        for (host, segs), c in shapes.items():
            children.setdefault(segs[i] if i < len(segs) else "$", {})[host, segs] = c
        b, l, _ = total(shapes)
        nodes = {}
        for name, inner in children.items():
            cb, cl, _ = total(inner)
            node = "<~>" if cl else "<?>"
            if cl and 0 < b < l and abs(cb / cl - b / l) > 1.96 * (b / l * (1 - b / l) / cl) ** 0.5:
                node = name
            nodes.setdefault("$" if name == "$" else node, {}).update(inner)
        for node, inner in nodes.items():
            here = pure(total(inner), purity)
            if node == "$":
                out.update(dict.fromkeys(inner, (f"{prefix}/$", here)))
            else:
                descend(inner, f"{prefix}/{node}", here, i + 1)

    for host in {h for h, _ in labelled}:
        own = {k: c for k, c in labelled.items() if k[0] == host}
        descend(own, "", pure(total(own), 0.2), 0)
    return out


def test_trees_equal_a_plain_version(spark):
    dice = random.Random(1)
    rules = [urls.Rule("block", "a.io", "/x/"), urls.Rule("allow", "a.io", "/x/y/"),
             urls.Rule("block", "b.io", "/"), urls.Rule("allow", "b.io", "/z/x/")]
    found = ["http://" + dice.choice(["a.io", "b.io", "c.io"]) + "".join(
        "/" + dice.choice(["x", "y", "z", "some-long-slug", f"p{dice.randint(1, 99)}"])
        for _ in range(dice.choice([0, 1, 2, 2, 3, 5]))) + dice.choice(["", "/"]) for _ in range(400)]
    counts = {}
    rows = urls.judge(frame(spark, found), rules=rules).withColumn("segs", urls.segments(F.col("path"))).collect()
    for r in rows:
        c = counts.setdefault((r.host, tuple(r.segs)), [0, 0, 0])
        by = {x.name: x.verdict for x in rules}.get(r.rule)
        c[0] += by == "block"
        c[1] += by is not None
        c[2] += by is None
    want = plain_tree(counts)
    for r in rows:
        template, purity = want[r.host, tuple(r.segs)]
        assert r.template == template and r.purity == pytest.approx(purity, rel=1e-9), r.url


def test_rules_below_the_usual_depth_stay_apart(spark):
    rules = [urls.Rule("block", "h.io", f"/a/b/c/d/e/{k}/") for k in ("ads", "spam")]
    rules.append(urls.Rule("allow", "h.io", "/a/b/c/d/e/news/"))
    found = [f"http://h.io/a/b/c/d/e/{k}/{i}" for k in ("ads", "news", "spam", "other") for i in range(30)]
    got = verdicts(spark, found, rules=rules)
    purity = {u.split("/")[8]: r.purity for u, r in got.items()}
    assert purity["ads"] > 0.75 > purity["news"] and purity["other"] < purity["ads"]


def test_branches_that_differ_stay_apart(spark):
    rules = [urls.Rule("block", "h.io", "/bad/"), urls.Rule("allow", "h.io", "/good/")]
    found = [f"http://h.io/{k}/{i}" for k in ("bad", "good") for i in range(30)]
    templates = {r.template.split("/")[1]: r.verdict for r in verdicts(spark, found, rules=rules).values()}
    assert templates == {"bad": "block", "good": "allow"}


def test_segments_are_generalised(spark):
    found = ["http://h/a/12.html/0af3bb129c/x9", "http://h/a/7.html/deadbeef00/x1/y/z", "http://h/a//b/",
             "http://h/Why-cats_sleep-2/a-b"]
    pages = frame(spark, found)
    rows = pages.select(urls.segments(urls.path_of(pages["url"])).alias("s")).collect()
    assert [r.s for r in rows] == [
        ["a", "<n>.html", "<id>", "x<n>"], ["a", "<n>.html", "<id>", "x<n>", "y", "z"], ["a", "b"],
        ["<slug>", "a-b"],
    ]


def test_repeated_rows_clashing_names_and_an_empty_table(spark):
    pages = frame(spark, ["http://a.net/x"] * 3 + [None] * 2)
    pages = pages.selectExpr("*", "1 AS Host", "2 AS s0", "3 AS _s0", "4 AS verdict", "5 AS _by_rule", "6 AS purity")
    rows = urls.judge(pages).collect()
    assert [r.verdict for r in rows if r.url] == ["block"] * 3 and len(rows) == 5
    assert {(r.s0, r._s0, r._by_rule) for r in rows} == {(2, 3, 5)} and rows[0].host == "a.net"
    assert urls.judge(frame(spark, [])).collect() == []


def test_plan_has_no_python(spark, sf_dir):
    judged = urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))
    assert "Python" not in judged._jdf.queryExecution().executedPlan().toString()
