"""URL filter: parsing, rules, templates; against the SQL on awkward rows."""

from __future__ import annotations

import duckdb
import pandas as pd

from jobloom.llm import urlfilter
from jobloom.llm.queries import URL_RULES

URLS = [
    "http://a.example.net/en/1", "HTTP://A.EXAMPLE.NET/de/1", "https://example.com/de/x?y#z", "https://example.com/dex", "https://notexample.com/de/x", "http://x.org/fr/1",
    "http://x.org/fr", "no scheme", "", None, "://", "http://?q", "http://h.net#/en/", "http://É.net/a", "http://a.org//fr//", "a://b://c/d", "http://x.org/fr/\nline", "http://net/x", "http://example.net/en/",
]


def judged(spark, urls):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, node string, template string")
    return urlfilter.judge(spark, pages, URL_RULES).toPandas().sort_values("page_id").reset_index(drop=True)


def brute(rows, rules):
    """The tree in plain Python: rows of a node by segment, node after node to the end of every path."""
    label = [rules.get(r.rule) for r in rows.itertuples()]

    def tally(ids):
        b = sum(label[i] == "block" for i in ids)
        a = sum(label[i] == "allow" for i in ids)
        return len(ids), b, a

    def differs(own, whole):
        n, b, a = own
        total, total_b, total_a = whole
        chi = 0.0
        for mine, both in ((b, total_b), (a, total_a), (n - b - a, total - total_b - total_a)):
            for of, size in ((mine, n), (both - mine, total - n)):
                expected = both * size / total
                chi += (of - expected) ** 2 / expected if expected else 0
        return n >= 4 and chi >= 9.21

    left = [r.path[1:].split("/") if r.path else [] for r in rows.itertuples()]
    node, template, more = rows.host.tolist(), rows.host.tolist(), [False] * len(rows)
    for level in range(max(map(len, left))):
        wholes, branches = {}, {}
        going = [i for i in range(len(rows)) if len(left[i]) > level]
        for i in going:
            wholes.setdefault(node[i], []).append(i)
            branches.setdefault((node[i], left[i][level]), []).append(i)
        for (above, segment), ids in branches.items():
            kept = differs(tally(ids), tally(wholes[above]))
            token = ("\\" if segment.lstrip("\\") in ("*", "**") else "") + segment if kept else "*"
            for i in ids:
                node[i] = f"{above}/{token}"
                named = kept or level < 3
                template[i] = node[i] if named else template[i]
                more[i] = len(left[i]) > level + 1 or not named
    template = [t + "/**" if m else t for t, m in zip(template, more, strict=True)]
    sums = {}
    for t, lab in zip(template, label, strict=True):
        b, a = sums.get(t, (0, 0))
        sums[t] = b + (lab == "block"), a + (lab == "allow")
    all_b, all_a = sum(b for b, _ in sums.values()), sum(a for _, a in sums.values())
    prior = min((all_b + 1) / (all_b + all_a + 2), 0.5)
    bad = {t for t, (b, a) in sums.items() if (b + 4 * prior) / (b + a + 4) >= 0.9}
    return template, [lab or ("block" if t in bad else "allow") for t, lab in zip(template, label, strict=True)]


def three_ways(spark, urls, rules):
    """The operator, its SQL and the plain tree agree; the operator's rows."""
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, node string, template string")
    mine = urlfilter.judge(spark, pages, rules).toPandas().sort_values("page_id").reset_index(drop=True)
    con = duckdb.connect()
    con.register("pages", pd.DataFrame({"page_id": range(len(urls)), "url": urls}))
    theirs = con.sql(urlfilter.sql(rules)).df().sort_values("page_id").reset_index(drop=True)[list(mine.columns)]
    plain = lambda df: df.astype(object).where(df.notna(), None).values.tolist()
    assert plain(mine) == plain(theirs)
    template, verdict = brute(mine, rules)
    assert mine.template.tolist() == template and mine.verdict.tolist() == verdict
    return mine


def test_same_as_sql_and_plain_tree(spark, rng):
    urls = URLS + [f"http://{h}.example.{t}/{rng.choice(['en', 'de', 'fr'])}/{rng.randint(0, 99999)}{rng.choice(['', '/', '.html', '/a/b/c'])}" for h in "abc" for t in ("com", "org") for _ in range(60)]
    three_ways(spark, urls, URL_RULES)


def test_deep_paths_and_stars_three_ways(spark, rng):
    """Sections that differ after the third segment, stars as segments, repeated urls, many more blocked labels than allowed ones."""
    words = ["a", "b", "*", "**", "\\*", "", "ä"]
    urls = [f"http://h{rng.randint(0, 2)}.io/" + "/".join(rng.choice(words) if rng.random() < 0.8 else str(rng.randint(0, 99)) for _ in range(rng.randint(0, 7))) for _ in range(900)]
    rules = {"h0.io/a/b/": "block", "h0.io/a/b/a": "allow", "h1.io/": "block", "h2.io/*/": "block", "h2.io/**/a/": "allow", "h2.io/b/b/b/": "block"}
    rows = three_ways(spark, urls, rules)
    assert rows.template.str.contains(r"\\\*", regex=True).any()


def test_one_sided_rules_three_ways(spark):
    rows = three_ways(spark, [f"http://a.net/{i}" for i in range(100)] + [f"http://clean.org/{i}" for i in range(20)], {"net/": "block"})
    assert (rows.verdict[rows.host == "clean.org"] == "allow").all()


def test_null_ids_repeats_and_long_paths(spark):
    """Repeated rows and null ids give a row each; a path of 150 segments is walked like any other."""
    urls = [(None, "http://a.net/x")] * 3 + [(7, "http://a.net/x")] * 2 + [(8, "http://b.org/" + "/".join(["s"] * 150))]
    rows = urlfilter.judge(spark, spark.createDataFrame(urls, "page_id long, url string"), URL_RULES).toPandas()
    assert len(rows) == 6 and rows.page_id.isna().sum() == 3
    assert set(rows.verdict[rows.host == "a.net"]) == {"block"} and rows.template[rows.host == "b.org"].tolist() == ["b.org/*/*/*/**"]


def test_hosts_paths_and_rules(spark):
    rows = judged(spark, URLS).set_index("page_id")
    assert rows.loc[0, ["host", "path", "rule", "verdict"]].tolist() == ["a.example.net", "/en/1", "example.net/en/", "allow"]
    assert rows.loc[1, ["host", "rule", "verdict"]].tolist() == ["a.example.net", "net/", "block"]
    assert rows.loc[2, ["path", "rule"]].tolist() == ["/de/x", "example.com/de/"]
    assert rows.rule.isna()[[3, 4, 6, 7, 8, 9, 10]].all()
    assert rows.loc[[7, 8, 9, 10], ["host", "path"]].eq("").all().all()
    assert rows.loc[13, "host"] == "É.net"
    assert rows.loc[15, ["host", "path"]].tolist() == ["b:", "//c/d"]


def test_template_with_pure_blocked_urls_is_rejected(spark):
    rules = {"spam.io/ads/": "block", "ok.io/": "allow"}
    urls = [f"http://spam.io/ads/{i}" for i in range(60)] + ["http://spam.io/adx"] + [f"http://ok.io/{i}" for i in range(60)] + [f"http://spam.io/news/{i}" for i in range(30)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = urlfilter.judge(spark, pages, rules).toPandas().set_index("page_id")
    assert (rows.verdict[:60] == "block").all() and (rows.verdict[61:] == "allow").all()
    assert rows.template[0] == "spam.io/ads/*" and rows.template[130] == "spam.io/news/*"


def test_labels_of_other_templates_reject_none(spark):
    rules = {"spam.io/": "block", "ok.io/": "allow"}
    urls = [f"http://spam.io/ads/{i}" for i in range(200)] + ["http://ok.io/1"] + [f"http://clean.io/news/{i}" for i in range(30)]
    for some, known in ((urls, rules), (urls[:200] + urls[201:], {"spam.io/": "block"})):
        pages = spark.createDataFrame(list(enumerate(some)), "page_id long, url string")
        rows = urlfilter.judge(spark, pages, known).toPandas()
        assert (rows.verdict[rows.host == "spam.io"] == "block").all() and (rows.verdict[rows.host != "spam.io"] == "allow").all()


def test_deep_and_small_sections_are_told_apart(spark):
    """Sections that differ from segment 5 on, and 30 even ones of which none has a twentieth of its node's urls."""
    urls = [f"http://deep.io/v1/site/users/{i}/{part}/{i}" for i in range(40) for part in ("spam", "profile")] + [f"http://h.io/s{k}/{i}" for k in range(30) for i in range(40)]
    rules = {f"deep.io/v1/site/users/{i}/spam/": "block" for i in range(30)} | {"h.io/s7/": "block"}
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = urlfilter.judge(spark, pages, rules).toPandas().sort_values("page_id")
    spam, s7 = rows.path.str.contains("/spam/"), rows.path.str.startswith("/s7/")
    assert (rows.verdict[spam | s7] == "block").all() and (rows.verdict[~spam & ~s7] == "allow").all()
    assert rows.rule[spam].isna().sum() == 10
    assert set(rows.template[spam]) == {"deep.io/*/*/*/*/spam/**"}
    assert set(rows.template[s7]) == {"h.io/s7/*"}


def test_no_pages(spark):
    assert urlfilter.judge(spark, spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0
    assert urlfilter.judge(spark, spark.createDataFrame([(1, "http://a/b")], "page_id long, url string"), {}).first().verdict == "allow"
