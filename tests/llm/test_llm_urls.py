import math
import re
from collections import defaultdict

import pytest
from lakehist.llm import urls
from lakehist.llm.urls import RULES, Rule, judged

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = re.search(r"[/?#]", rest)
    host, tail = (rest[:cut.start()], rest[cut.start():]) if cut else (rest, "")
    return host.translate(LOWER), re.split(r"[?#]", tail)[0]


def rule_of(host, path, rules=RULES):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def brute(urls):
    """Verdict, template and purity of each url, by dictionaries."""
    pages = defaultdict(int)
    for u in urls:
        pages[parts(u)] += 1
    own = {k: [re.sub("[0-9]+", "#", s) for s in k[1].split("/") if s] for k in pages}
    children = defaultdict(lambda: defaultdict(float))
    for (host, path), n in pages.items():
        segments = own[host, path]
        for i, s in enumerate(segments):
            children[host, "/".join(segments[:i]), i][s] += n
    wild = set()
    for node, kids in children.items():
        n = sum(kids.values())
        if n * n > 16 * sum(c * c for c in kids.values()):
            wild |= {(node, s) for s, c in kids.items() if 20 * c < n}
    template = {}
    for k, segments in own.items():
        template[k] = tuple("*" if ((k[0], "/".join(segments[:i]), i), s) in wild else s for i, s in enumerate(segments))
    seen = defaultdict(lambda: [0.0, 0.0])
    for k, n in pages.items():
        rule = rule_of(*k)
        cell = seen[k[0], template[k]]
        cell[0] += n * (rule is not None)
        cell[1] += n * (rule is not None and rule.verdict == "block")
    now = {key: key[1] for key in seen}
    for level in range(max(map(len, now.values()), default=0), 0, -1):
        families = defaultdict(lambda: defaultdict(lambda: [0.0, 0.0]))
        for key, t in now.items():
            if len(t) >= level:
                cell = families[key[0], t[:level - 1], t[level:]][t[level - 1]]
                cell[0] += seen[key][0]
                cell[1] += seen[key][1]
        alike = set()
        for family, kids in families.items():
            known = [c for c in kids.values() if c[0]]
            n, b = sum(c[0] for c in known), sum(c[1] for c in known)
            if len(known) >= 2:
                free, p = len(known) - 1, b / n
                spread = sum(c[1] * c[1] / c[0] for c in known) - b * b / n
                if b in (0, n) or spread <= p * (1 - p) * (free + 2 * math.sqrt(2 * free)):
                    alike.add(family)
        for key, t in now.items():
            if len(t) >= level and (key[0], t[:level - 1], t[level:]) in alike:
                now[key] = t[:level - 1] + ("*",) + t[level:]
    n, b = sum(c[0] for c in seen.values()), sum(c[1] for c in seen.values())
    share = (b + 1) / (n + 2)
    host_sums, wide_sums = defaultdict(lambda: [0.0, 0.0]), defaultdict(lambda: [0.0, 0.0])
    for key, t in now.items():
        for cell in (host_sums[key[0], t], wide_sums[t]):
            cell[0] += seen[key][0]
            cell[1] += seen[key][1]
    out = {}
    for u in urls:
        k = parts(u)
        t = now[k[0], template[k]]
        wide = (wide_sums[t][1] + 4 * share) / (wide_sums[t][0] + 4)
        purity = (host_sums[k[0], t][1] + 4 * wide) / (host_sums[k[0], t][0] + 4)
        rule = rule_of(*k)
        verdict = rule.verdict if rule else ("block" if purity > 0.5 else "allow")
        out[u] = (*k, rule.text if rule else None, verdict, "/" + "/".join(t), round(purity, 9))
    return out


def check(pages):
    rows = pages.collect()
    expected = brute([r["url"] for r in rows])
    found = judged(pages).collect()
    assert sorted(tuple(r)[0] or -1 for r in found) == sorted(r["page_id"] or -1 for r in rows)
    urls = {r["page_id"]: r["url"] for r in rows}
    for r in found:
        want = expected[urls[r["page_id"]]]
        assert tuple(r)[1:-1] == want[:-1]
        assert r["purity"] == pytest.approx(want[-1], abs=2e-9)


def test_real_pages(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def test_trees_with_names_and_dates(spark):
    urls = [f"http://a.org/user/name{chr(97 + i % 26)}{chr(97 + i // 26)}/photos/{i}" for i in range(80)]
    urls += [f"http://b.com/{lang}/{i % 3}/x" for lang in ("de", "fr", "it") for i in range(9)]
    urls += [f"http://c.com/blog/de/{i}" for i in range(5)] + ["http://c.net/de/7", "http://c.net/user/x/photos/1"]
    check(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, rule string"))


def test_deep_paths_merge_at_every_level(spark):
    urls = [f"http://d.com/de/x/y/z/{a}/q/{b}" for a in ("one", "two", "three") for b in ("k", "l") for _ in range(3)]
    urls += [f"http://d.com/fr/x/y/z/{a}/q/k" for a in ("one", "two")] + [f"http://e.net/de/x/y/z/one/q/{b}" for b in ("k", "other")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    check(pages)
    assert "/de/x/y/z/*/q/*" in {r["template"] for r in judged(pages).collect()}


def test_odd_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "http:///x", "HTTP://UP.Example.ORG/en/1?x#y", "http://example.org", "http://example.org?q=/es/",
        "http://notexample.org/es/1", "http://example.org/es/", "http://sub.example.org/es/a//b", "x://y://z/w", "http://com/de/", "http://com/de/",
        "http://ÄÖ.com/FR/", "http://a.com/fr/é", "http://org/" + "/".join("abcdefghij" * 40), "ftp://u@h.com:80/de/",
    ]
    check(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))


def test_no_rules_and_nothing(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c"), (None, "http://a.b/d")], "page_id long, url string")
    assert {r["verdict"] for r in judged(pages, rules=()).collect()} == {"allow"}
    assert judged(pages.limit(0)).collect() == []


def test_equal_rules_take_the_first(spark):
    pages = spark.createDataFrame([(1, "http://x.ab/c")], "page_id long, url string")
    for first, second in (("allow", "block"), ("block", "allow")):
        rules = (Rule(first, "ab", "/"), Rule(second, "ab", "/"))
        assert judged(pages, rules).first()["verdict"] == first


def rounds_of(spark, monkeypatch, found):
    """How many times templates were merged, and the verdicts."""
    levels, merge = [], urls._merged
    monkeypatch.setattr(urls, "_merged", lambda counts, level: levels.append(level) or merge(counts, level))
    frame = spark.createDataFrame(list(enumerate(found)), "page_id long, url string").repartition(3)
    rows = {r["url"]: (r["verdict"], r["template"]) for r in judged(frame).join(frame, "page_id").collect()}
    monkeypatch.undo()
    return levels, rows


def test_deep_paths_cost_a_round_only_where_siblings_differ(spark, monkeypatch):
    """A trap of two urls with forty segments each adds no round, or one where they differ in one segment."""
    plain = [f"http://shop.com/{lang}/item{i % 5}" for lang in ("fr", "de") for i in range(20)]
    trap = ["/".join(f"s{i * k}" for i in range(40)) for k in (1, 3)]
    twins = ["/".join(["deep"] * 19 + [end] + ["deep"] * 20) for end in ("a", "b")]
    levels, rows = rounds_of(spark, monkeypatch, plain)
    trapped, more = rounds_of(spark, monkeypatch, plain + [f"http://trap.com/fr/{t}" for t in trap])
    assert trapped == levels and len(levels) <= 2
    assert {u: v for u, v in more.items() if "trap" not in u} == rows
    deep, more = rounds_of(spark, monkeypatch, plain + [f"http://trap.com/fr/{t}" for t in twins])
    assert sorted(set(deep) - set(levels)) == [21] and len(deep) == len(levels) + 1
    for url in (f"http://trap.com/fr/{t}" for t in twins):
        assert more[url][1] == "/fr/" + "/".join(["deep"] * 19 + ["*"] + ["deep"] * 20)


def test_merges_that_make_siblings_further_up(spark):
    """Two wildcards behind make templates alike that differed in two segments."""
    found = [f"http://a.com/fr/{x}/{y}" for x in "pqr" for y in "uvw"] + [f"http://b.com/fr/{x}" for x in "pq"] + ["http://c.com/fr/z", "http://c.com/q/z"]
    expected = brute(found)
    frame = spark.createDataFrame(list(enumerate(found)), "page_id long, url string")
    for r in judged(frame).collect():
        verdict, template, purity = expected[found[r["page_id"]]][3:6]
        assert (r["verdict"], r["template"]) == (verdict, template) and r["purity"] == pytest.approx(purity, abs=1e-8)
    assert {r["template"] for r in judged(frame).where("host = 'a.com'").collect()} == {"/fr/*/*"}
