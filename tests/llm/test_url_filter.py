import duckdb

from logsmith.llm.queries import URL_FILTER_SQL
from logsmith.llm.url_filter import judge_urls, link_edges

SCHEMA = "page_id long, url string, html string, node long, verdict string"


def link(to):
    return f'<html><head><link href="{to}" rel="canonical"></head></html>'


def refresh(to):
    return f"<meta http-equiv='refresh' content='0; URL={to}'>"


def judge(spark, rows):
    df = spark.createDataFrame([(i, u, h, 1, "clash") for i, u, h in rows], SCHEMA)
    return {r.page_id: r for r in judge_urls(df).collect()}


def test_rules_hosts_and_paths(spark):
    got = judge(spark, [
        (1, "http://A.Example.NET/en/1?x#y", ""), (2, "https://b.net/x", None), (3, "http://example.com/de/5", ""),
        (4, "http://m.example.com/en", ""), (5, "ftp://x.org/fr/", ""), (6, "no url", ""), (7, None, None),
        (8, "http://example.network/", ""), (9, "http://net?q", ""), (10, "http://example.net#/en/", ""),
        (11, "x://a.org/fr/?u=http://b.net/", "")])
    assert [(r.host, r.path, r.rule, r.verdict) for _, r in sorted(got.items())] == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("b.net", "/x", "net/", "block"),
        ("example.com", "/de/5", "example.com/de/", "block"), ("m.example.com", "/en", None, "allow"),
        ("x.org", "/fr/", "org/fr/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("example.network", "/", None, "allow"), ("net", "", None, "allow"), ("example.net", "", None, "allow"),
        ("a.org", "/fr/", "org/fr/", "allow")]


def test_blocks_reach_aliases_and_allow_has_precedence(spark):
    chain = [(i, f"http://c{i}.com/p", link(f"http://c{i + 1}.com/p")) for i in range(30)]
    got = judge(spark, chain + [
        (30, "http://c30.com/p#frag", refresh("https://bad.net/")),       # blocked by its target's rule
        (40, "http://d.com/", link("https://bad2.net/")), (41, "http://e.com/", link("http://d.com/")),
        (42, "https://ok.org/fr/", refresh("http://e.com/")),             # allowed explicitly: so are its aliases
        (50, "http://lone.com/", ""), (51, "https://bad.net/", "")])
    assert {got[i].verdict for i in range(31)} == {"block"} and got[0].rule is None
    assert [got[i].verdict for i in (40, 41, 42, 50, 51)] == ["allow", "allow", "allow", "allow", "block"]


def test_empty_and_repeated(spark):
    assert judge_urls(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(None, "http://a.net/", None, 1, "x")] * 3, SCHEMA)
    assert [r.verdict for r in judge_urls(df).collect()] == ["block"] * 3


def test_relative_links(spark):
    page = "http://A.com/x/y/p?q#f"
    wanted = {"/r": "http://a.com/r", "//Bad.net/k": "http://bad.net/k", "n": "http://a.com/x/y/n", "../u?v=/../w": "http://a.com/x/u?v=/../w",
              "./": "http://a.com/x/y/", "..": "http://a.com/x/", "../../../../t": "http://a.com/t", "?z": "http://a.com/x/y/p?z",
              "https://b.com/../c": "https://b.com/../c", "/a/b/../..": "http://a.com/", "/a//b/./c#d": "http://a.com/a//b/c"}
    rows = [(1, page, link(t), 1, "x") for t in [*wanted, "mailto:a@b.com", "#frag"]]
    edges = {(r.source, r.target) for r in link_edges(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert edges == {("http://a.com/x/y/p?q", t) for t in wanted.values()}


def test_relative_links_as_in_sql(spark):
    targets = ["/r", "//bad.net/k", "n", "../u", "..", ".", "./", "/a/b/..", "../../../t", "?z", "#f", "mailto:x", "a/./b/../c?d=../e"]
    rows = [(100 * i + j, f"http://h{i}.com{p}", link(t), 1, "x") for i, t in enumerate(targets) for j, p in enumerate(["", "/", "/x", "/x/y?q"])]
    # one more page for each address that is a target, tied to a blocked one
    ends = [r.target for r in link_edges(spark.createDataFrame(rows, SCHEMA)).collect()]
    rows += [(10_000 + i, t, link("https://blocked.net/") if i % 2 else "", 1, "x") for i, t in enumerate(sorted(set(ends)))]
    rows += [(20_000, "no address", link("/r"), 1, "x"), (20_001, None, link("/r"), 1, "x")]
    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in judge_urls(spark.createDataFrame(rows, SCHEMA)).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR, node BIGINT, verdict VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?, ?, ?)", rows)
    want = con.execute(f"SELECT page_id, host, path, coalesce(rule, ''), verdict FROM ({URL_FILTER_SQL})").fetchall()
    assert got == sorted(want)
    assert {v for *_, v in got} == {"allow", "block"}
