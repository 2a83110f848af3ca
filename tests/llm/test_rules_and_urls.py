import random
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from crashlake.llm import op6_url_filter as url
from crashlake.llm import op7_rules as rules
from crashlake.llm.oracle import ORACLE
from crashlake.llm.queries import QUERIES
from tests.llm.helpers import documents, frame, sentence, word_list

SF = "/root/testdata/sf0.001"


def plain_statistics(text):
    text = text or ""
    w = word_list(text)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if word_list(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


ODD = ["a b c a b c", "a b c x a b c a b c", "a a a a", "a b\n\na b\n a b\n\t\nq", "#$% <b>|&*", "x", "é é\u2003é", "a\x1cb c", "😀 😀 😀 😀", "1\r2\x0b3\x0c4"]


def test_base_statistics(spark):
    rows = [(i, t, "en", "s", 0, "", "", "", "", "") for i, t in enumerate(ODD)] + documents()
    got = rules.with_statistics(frame(spark, rows)).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_statistics(r.doc.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_outliers_go_and_plain_texts_stay(spark):
    rows = documents(n=600)
    bad = [(9000 + i, " ".join(w + "%%%" for w in word_list(r[1])), *r[2:]) for i, r in enumerate(rows[:600]) if r[1] and 50 <= len(word_list(r[1])) < 400 and r[0] is not None][:40]
    docs = frame(spark, rows + bad)
    got = rules.judge(rules.with_statistics(docs))
    assert got.count() == len(rows) + len(bad)
    out = got.select("doc.doc_id", "n_words", "base_failed", "kept").collect()
    assert not any(r.kept for r in out if r.base_failed)
    assert not any(r.kept for r in out if r.doc_id is not None and r.doc_id >= 9000)
    assert all(r.kept for r in out if not r.base_failed and (r.doc_id is None or r.doc_id < 9000))
    assert got.select("doc.*").columns == docs.columns


def test_each_measure_can_reject_alone(spark):
    rows = [(i, " ".join(f"w{(i * 997 + 31 * k) % 900 + 100}" for k in range(100)), "en", "s", 0, "", "", "", "", "") for i in range(60)]
    plain = rows[0][1].split()
    odd = {100: plain[:56] + plain[:22] + plain[56:78],  # 44 of 100 words in repeated windows
           101: ["#" + w[1:] for w in plain[:6]] + plain[6:],  # six signs
           102: [w + "xx" for w in plain]}  # longer words
    lines = "\n".join(["aaaa bbbb"] * 7 + [" ".join(plain[14 + 8 * k:22 + 8 * k]) for k in range(11)])
    texts = {k: " ".join(v) for k, v in odd.items()} | {103: lines}
    got = rules.judge(rules.with_statistics(frame(spark, rows + [(k, t, *rows[0][2:]) for k, t in texts.items()])))
    out = {r.doc_id: r for r in got.select("doc.doc_id", "base_failed", "kept", "n_repeat_words", "n_symbols").collect()}
    assert not any(r.base_failed for r in out.values()) and (out[100].n_repeat_words, out[101].n_symbols) == (44, 6)
    assert {k for k, r in out.items() if not r.kept} == set(texts)


def plain_rows(seed, n, source, first=0):
    """Different plain texts of one language and source."""
    rng = random.Random(seed)
    return [(first + i, sentence(rng, rng.randint(60, 150)), "en", source, 0, "", "", "", "", "") for i in range(n)]


@pytest.mark.parametrize("share", [5, 20, 26, 33, 45, 70])
def test_copies_of_a_junk_text_do_not_make_the_rule(spark, share):
    clean = plain_rows(share, 300, "s")
    copies = 300 * share // (100 - share)
    junk = " ".join(w + "#$" for w in word_list(clean[0][1]))
    got = rules.judge(rules.with_statistics(frame(spark, clean + [(10_000 + k, junk, *clean[0][2:]) for k in range(copies)])))
    kept = {r.doc_id: r.kept for r in got.select("doc.doc_id", "kept").collect()}
    assert not any(k for i, k in kept.items() if i >= 10_000)
    assert sum(k for i, k in kept.items() if i < 10_000) >= 297


@pytest.mark.parametrize("share", [5, 20, 33, 45])
def test_different_junk_texts_up_to_near_half(spark, share):
    clean, bad = plain_rows(share, 300, "s"), plain_rows(share + 1, 300 * share // (100 - share), "s", 10_000)
    bad = [(r[0], " ".join(w + "#$" for w in word_list(r[1])), *r[2:]) for r in bad]
    kept = {r.doc_id: r.kept for r in rules.judge(rules.with_statistics(frame(spark, clean + bad))).select("doc.doc_id", "kept").collect()}
    assert not any(k for i, k in kept.items() if i >= 10_000)
    assert sum(k for i, k in kept.items() if i < 10_000) >= 295


def test_small_groups_rest_on_their_language(spark):
    rows = plain_rows(1, 200, "big")
    for n in (1, 2, 3):
        for k in range(n):
            text = plain_rows(50 * n + k, 1, "x")[0][1]
            rows.append((1000 + 10 * n + k, text, "en", f"clean{n}", 0, "", "", "", "", ""))
            rows.append((2000 + 10 * n + k, " ".join(w + "%%" for w in word_list(text)), "en", f"junk{n}", 0, "", "", "", "", ""))
            rows.append((3000 + 10 * n + k, " ".join(w + "%%" for w in word_list(text)), None, None, 0, "", "", "", "", ""))
    kept = {r.doc_id: r.kept for r in rules.judge(rules.with_statistics(frame(spark, rows))).select("doc.doc_id", "kept").collect()}
    assert all(k for i, k in kept.items() if 1000 <= i < 2000) and not any(k for i, k in kept.items() if i >= 2000)


def test_rules_on_few_rows_and_none(spark):
    docs = frame(spark, documents())
    assert rules.judge(rules.with_statistics(docs.limit(0))).count() == 0
    one = frame(spark, [r for r in documents() if len(word_list(r[1])) >= 60][:1])
    assert rules.judge(rules.with_statistics(one)).select("kept").first()[0]


@pytest.mark.parametrize("text,host,path", [
    ("http://A.Example.com/en/x?q#f", "a.example.com", "/en/x"), ("https://h", "h", ""), ("x://h?y", "h", ""), ("h/no", "", ""), (None, "", ""),
    ("a://b://c/d", "b:", "//c/d"), ("http://ÄÖ.net/es/", "ÄÖ.net", "/es/"), ("s://h#/x", "h", ""), ("", "", ""), ("http:///p", "", "/p"), ("s://h/a\nb", "h", "/a\nb"),
])
def test_host_and_path(spark, text, host, path):
    row = spark.createDataFrame([(text,)], "u string").select(url.host(F.col("u")), url.path(F.col("u"))).first()
    assert tuple(row) == (host, path)


@pytest.mark.parametrize("host,path,want", [
    ("com", "/", "com/"), ("x.com", "/en/", "com/"), ("example.com", "/en/q", "example.com/en/"), ("www.example.com", "/en/q", "www.example.com/en/"),
    ("a.www.example.com", "/en/", "www.example.com/en/"), ("notexample.com", "/en/", "com/"), ("telecom", "/", None), ("a.net", "/es/1", "net/es/"),
    ("a.net", "/en/", None), ("x.com", "", None), ("", "", None),
])
def test_longest_rule(spark, host, path, want):
    row = spark.createDataFrame([(host, path)], "h string, p string").select(url.rule(F.col("h"), F.col("p")).alias("r")).first().r
    assert (row and row.rule) == want


def test_links_carry_trust_and_distrust(spark):
    link = '<a href="http://{}/x">'
    rows = [(1, "http://good.com/a", link.format("FRIEND.org") + "<a HREF='//friend.org/b'>" + '<a href="/local">'),
            (2, "http://friend.org/a", link.format("next.org")), (3, "http://next.org/a", None), (4, "http://bad.net/es/1", ""),
            (5, "http://farm.org/a", link.format("bad.net")), (6, "http://lone.org/a", ""), (7, None, link.format("x.org")), (7, None, None), (8, "no url", "")]
    pages = spark.createDataFrame([(*r, "d", "h", 1) for r in rows], "page_id bigint, url string, html string, doc string, host string, verdict int")
    got = {(r.doc.page_id, r.verdict, (r.trust or 0) > 0, (r.distrust or 0) > 0) for r in url.judge(pages, domains=False).collect()}
    assert got == {(1, "allow", True, False), (2, "allow", True, False), (3, "allow", True, False), (4, "block", False, True), (5, "block", False, True),
                   (6, "allow", False, False), (7, "allow", False, False), (8, "allow", False, False)}
    assert url.judge(pages.limit(0)).count() == 0
    edge = {(r.src, r.dst): r.weight for r in url.edges(pages.select(url.host(F.col("url")).alias("host"), "html"), domains=False).collect()}
    assert edge[("good.com", "friend.org")] == 2 and len(edge) == 3


def plain_ranks(edges, seeds, rounds):
    total = sum(seeds.values())
    start = {h: int(url.UNIT * url.SEEDS * (n / total)) for h, n in seeds.items() if n}
    out = Counter()
    for (s, _), w in edges.items():
        out[s] += w
    rank = dict(start)
    for _ in range(rounds):
        new = Counter({h: int((1 - url.DAMPING) * r) for h, r in start.items()})
        for (s, d), w in edges.items():
            if s in rank:
                new[d] += int(url.DAMPING * (rank[s] * (w / out[s])))
        rank = new
    return {h: r for h, r in rank.items() if r}


def test_ranks_equal_the_plain_iteration(spark):
    edges = {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1, ("c", "a"): 5, ("d", "c"): 1, ("c", "e"): 1}
    df = spark.createDataFrame([(*k, w) for k, w in edges.items()], "src string, dst string, weight bigint")
    seeds = spark.createDataFrame([("a", 3, 0), ("d", 1, 2), ("e", 0, 5)], "host string, trusted bigint, blocked bigint")
    got = url.propagate(df, seeds).collect()
    assert {r.host: r.trust for r in got if r.trust} == plain_ranks(edges, {"a": 3, "d": 1}, url.ROUNDS)
    assert {r.host: r.distrust for r in got if r.distrust} == plain_ranks({(d, s): w for (s, d), w in edges.items()}, {"d": 2, "e": 5}, url.ROUNDS)


@pytest.mark.parametrize("n", [40, 70])
def test_a_chain_of_hosts_ends_in_one_verdict(spark, n):
    """Each host links to the next, the last is blocked; a branch of trusted hosts stays allowed."""
    link = '<a href="https://{}/x">'
    rows = [(i, f"http://h{i}.org/", link.format(f"h{i + 1}.org")) for i in range(n)] + [(n, f"http://h{n}.org/", link.format("bad.net")), (n + 1, "http://bad.net/es/1", None)]
    rows += [(1000, "http://shop.com/", link.format("friend.org")), (1001, "http://friend.org/", "x" * 300_000)]
    got = {r.doc.page_id: r.verdict for r in url.judge(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {got[i] for i in range(n + 2)} == {"block"} and got[1000] == got[1001] == "allow"


def test_a_top_level_domain_joins_no_hosts(spark):
    pages = spark.createDataFrame([("a.b.example.com", ""), ("www.other.com", ""), ("com", ""), ("example.com", "")], "host string, html string")
    got = {(r.src, r.dst) for r in url.edges(pages).collect()}
    pairs = {("a.b.example.com", "b.example.com"), ("b.example.com", "example.com"), ("www.other.com", "other.com")}
    assert got == pairs | {(b, a) for a, b in pairs}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLE[name]).df()[list(got.columns)]
    order = [c for c in ("doc_id", "page_id", "query_id", "lang", "rank") if c in got.columns]
    pd.testing.assert_frame_equal(got.sort_values(order).reset_index(drop=True), want.sort_values(order).reset_index(drop=True), check_dtype=False, rtol=1e-9)
