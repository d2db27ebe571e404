"""Address filtering against plain Python: hosts, written rules, mined combinations, verdicts."""

import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.llm import queries, url_filter

ODD = [
    (1, "HTTP://WWW.Example.COM/en/page"),
    (2, "http://example.com/en/"),
    (3, "http://example.com/en"),
    (4, "http://a.b.example.com/en/x?y=://z"),
    (5, "http://notexample.com/en/x"),
    (6, "http://example.com.evil.org/en/"),
    (7, "https://x.net/es/1"),
    (8, "https://x.net/es"),
    (9, "https://net/fr/"),
    (10, None),
    (11, ""),
    (12, "no scheme at all"),
    (13, "://"),
    (14, "http://"),
    (15, "http://example.com"),
    (16, "http://example.com?en/"),
    (17, "http://example.com#/en/"),
    (18, "http://ÉÄ.com/é\n/x"),
    (19, "http://com/"),
    (20, "http://www.www.example.com//en/"),
    (21, "ftp://x://y/z?a&b=1&a#f"),
    (None, "http://x.net/es/1"),
    (7, "https://x.net/es/1"),
    (22, "http://long.org/" + "a/" * 5000 + "?" + "&".join(f"k{i}=1" for i in range(300))),
]


def plain_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain_rest(url):
    return url.split("://", 1)[1] if url and "://" in url else ""


def plain_parts(url):
    rest = plain_rest(url)
    host = re.match(r"[^/?#]*", rest)[0]
    return plain_lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path):
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def plain_tokens(url):
    if not url or "://" not in url:
        return ()
    url = re.sub("[0-9]+", "0", plain_lower(url))
    host, path = plain_parts(url)
    labels = host.split(".")
    query = re.match(r"[^?#]*\?([^#]*)", plain_rest(url), re.S)
    extension = re.search(r"\.([a-z0-9]+)$", path)
    out = ["s:" + url.split("://")[0], "h:" + labels[0], f"n:{len(labels)}", *(f"h{i}:{x}" for i, x in enumerate(reversed(labels), 1))]
    out += ["w:" + x for x in re.split("[.-]", host) if x]
    out += [f"p{i}:{x}" for i, x in enumerate((x for x in path.split("/") if x), 1)]
    out += ["e:" + extension[1]] if extension else []
    out += ["q:" + x.split("=")[0] for x in (query[1] if query else "").split("&") if x.split("=")[0]]
    out += ["f:"] if "#" in plain_rest(url) else []
    return tuple(sorted(set(out), key=lambda x: x.encode()))


def plain_judge(rows, min_support, min_confidence, max_items):
    parts = [(i, *plain_parts(u), plain_tokens(u)) for i, u in rows]
    known = [(t, plain_rule(h, p)[1]) for _, h, p, t in parts if plain_rule(h, p)[1]]
    least = min(max(min_support, url_filter.MIN_COUNT / max(len(known), 1)), 1.0)
    seen, bad = Counter(), Counter()
    for t, v in known:
        seen.update(t)
        bad.update(t if v == "block" else ())
    blocked = sum(v == "block" for _, v in known)
    telling = {x: abs(bad[x] * len(known) - n * blocked) / n for x, n in seen.items() if n >= least * len(known)}
    sets = Counter()
    for t, v in known:
        best = sorted((x for x in t if x in telling), key=lambda x: (-telling[x], x.encode()))[:max_items]
        sets[tuple(sorted(best)), v] += 1
    every, of = Counter(), Counter()
    for (t, v), n in sets.items():
        for size in range(1, len(t) + 1):
            for part in itertools.combinations(t, size):
                every[part] += n
                of[part, v] += n
    floor = -(-least * len(known) // 1)
    rules = [(n / every[p], n / len(known), -len(p), v, frozenset(p)) for (p, v), n in of.items() if n >= floor and n / every[p] >= min_confidence]
    out = []
    for i, h, p, t in parts:
        rule, verdict = plain_rule(h, p)
        fits = [r for r in rules if r[4] <= set(t)]
        out.append((i, h, p, rule, verdict or (max(fits, key=lambda r: r[:4])[3] if fits else "allow")))
    return out


def made_up(n, seed=3):
    rng, out = random.Random(seed), []
    for i in range(n):
        host = rng.choice(["", "www.", "m.", "blog."]) + rng.choice(["one", "two", "cheap-pills", "spam-farm"]) + ".example." + rng.choice(["com", "net", "org"])
        if i % 3 == 0:
            host = "hot.example.net"  # a third of all rows
        out.append((i, f"http{rng.choice(['', 's'])}://{host}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randint(1, 99)}{rng.choice(['', '.html', '?page=2', '#top'])}"))
    return out


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("rows, options", [(ODD + made_up(400), {}), (made_up(300, 9), {"min_support": 0.1, "min_confidence": 0.6, "max_items": 4}), (ODD, {})])
def test_verdicts_equal_brute_force(spark, rows, options):
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit(1) for c in ("id", "items", "key", "w", "host", "rule", "a b", "x.y")}).repartition(3)
    got = url_filter.judge(pages, queries.URL_RULES, **options)
    settings = {"min_support": url_filter.MIN_SUPPORT, "min_confidence": url_filter.MIN_CONFIDENCE, "max_items": url_filter.MAX_ITEMS} | options
    want = plain_judge(rows, *settings.values())
    same([tuple(r) for r in got.collect()], want)
    assert len(rows) < 100 or {w[4] for w in want if w[3] is None} == {"allow", "block"}


def test_tokens(spark):
    rows = [(u,) for _, u in ODD if u is not None]
    got = spark.createDataFrame(rows, "url string").select("url", url_filter.tokens_of(F.col("url")).alias("t")).collect()
    for r in got:
        assert tuple(r.t) == plain_tokens(r.url)


def test_without_labels_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://x.org/a"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge(pages, queries.URL_RULES).collect()} == {"allow"}
    assert {r.rule for r in url_filter.judge(pages, []).collect()} == {None}
    assert url_filter.judge(pages.limit(0), queries.URL_RULES).count() == 0


def test_query_columns(spark, tmp_path):
    spark.createDataFrame([(i, u, "<p>") for i, u in ODD], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op11_url_filter(spark, str(tmp_path))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"] and got.count() == len(ODD)


def test_no_token_is_left_out_of_the_rules(spark):
    """The blocked addresses have fifteen tokens that only they have; the last in order decides about the open one."""
    rows = [(i, f"http://aa.bb.cc.dd.ee.net/es/x{i}?zz=1") for i in range(20)] + [(20 + i, f"http://www.example.com/en/y{i}") for i in range(20)]
    rows += [(40, "ftp://other.org/a?zz=2"), (41, "ftp://other.org/a")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES)
    verdicts = {r.id: r.verdict for r in got.collect()}
    assert (verdicts[40], verdicts[41]) == ("block", "allow")
    mixed = made_up(150, 5)
    got = url_filter.judge(spark.createDataFrame(mixed, "page_id long, url string"), queries.URL_RULES, min_support=0.1)
    same([tuple(r) for r in got.collect()], plain_judge(mixed, 0.1, url_filter.MIN_CONFIDENCE, None))
