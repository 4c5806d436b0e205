import math
import random
from collections import Counter

from sitelens.llm import url_filter as uf

SCHEMA = "page_id long, url string, html string, host string, label string, suffix string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "", "x", "y", "z") for i, u in enumerate(urls)], SCHEMA).repartition(3)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules=uf.RULES):
    best = None
    for says, text in rules:
        name, _, rest = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(text) > len(best[1])):
            best = (says, text)
    return best


URLS = [None, "", "no scheme", "http://", "://a.com/x", "HTTP://WWW.Example.COM/en/a?b=c#d", "http://example.com/en/", "http://example.com/en",
        "http://a.example.com/en/x", "http://notexample.com/en/x", "http://x.net/es/1", "http://x.net/fr/", "http://net/es/", "http://x.com",
        "http://x.com?u=http://y.net/es/", "a b\nc://x.com/\n?q", "http://www.example.com/en/ä", "http://Ä.com/", "http://x.org/" + "9" * 20000,
        "http://x.com:80/a", "ftp://u@x.com//y", "http://x.net/es/1", "mailto:x#://y.com/en/"]


def test_rules_against_brute_force(spark):
    got = {r["page_id"]: r for r in uf.judge(pages(spark, URLS)).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = split(url)
        best = rule_of(host, path)
        assert (got[i]["host"], got[i]["path"]) == (host, path), url
        assert got[i]["rule"] == (best[1] if best else None), url
        assert got[i]["verdict"] in ("allow", "block")
        if best:
            assert got[i]["verdict"] == best[0]


def test_classifier_learns_lexical_patterns(spark):
    rng = random.Random(1)
    urls = []
    for i in range(400):
        urls.append(f"http://site{i % 7}.com/articles/page" if i % 2 else f"http://x{rng.randrange(10 ** 9)}.net/es/{rng.randrange(10 ** 9)}?a=1&b=2")
    urls += ["http://other.org/articles/page"] * 5 + ["http://x77123456.org/ab/991234567?a=1&b=2"] * 5
    got = {r["page_id"]: r["verdict"] for r in uf.judge(pages(spark, urls)).collect()}
    assert {got[i] for i in range(400, 405)} == {"allow"} and {got[i] for i in range(405, 410)} == {"block"}


def test_entropy(spark):
    texts = ["", "a", "abab", "http://x.com/äö?q=1", "$1\\d.*" * 9]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", uf.entropy(uf.F.col("t")).alias("e")).collect()
    for r in rows:
        n = len(r["t"])
        want = -sum(c / n * math.log2(c / n) for c in Counter(r["t"]).values()) if n else 0
        assert abs(r["e"] - want) < 1e-9, r


def test_one_class_none_and_empty(spark):
    assert uf.judge(pages(spark, [])).count() == 0
    assert {r["verdict"] for r in uf.judge(pages(spark, ["http://a.org/", None])).collect()} == {"allow"}
    only = uf.judge(pages(spark, ["http://a.net/es/1", "http://a.org/"])).collect()
    assert {r["verdict"] for r in only} == {"block"}


def labelled(spark, urls):
    return uf.lexical(pages(spark, urls)).withColumn("label", uf.F.when(uf.F.col("url").contains("good"), 1).when(uf.F.col("url").contains("bad"), 0))


def test_suffix_statistics_count_all_labelled_rows(spark):
    """Also suffixes that no row of the sample has, and repeated rows."""
    urls = [f"http://a{i}.s{i % 40}/{'good' if i % 3 else 'bad'}" for i in range(240)] + ["http://x.new/"] * 50 + ["http://x.s1/bad"] * 100
    _, stats, share = uf.train(labelled(spark, urls), sample_rows=10)
    got = {r["suffix"]: r for r in stats.collect()}
    labels = [(u.split("/")[2].split(".")[1], "good" in u) for u in urls if not u.endswith(".new/")]
    assert abs(share - sum(y for _, y in labels) / len(labels)) < 1e-12
    assert len(got) == 41 and got["new"]["suffix_share"] is None
    for s in {s for s, _ in labels}:
        mine = [y for t, y in labels if t == s]
        assert abs(got[s]["suffix_share"] - (sum(mine) + 10 * share) / (len(mine) + 10)) < 1e-12
        assert abs(got[s]["suffix_weight"] - math.log1p(len(mine))) < 1e-12


def test_repeated_url_takes_one_place_of_the_sample(spark):
    """Whatever the hash of the URL is: its copies alone would fill it."""
    urls = [f"http://{i}.com/good" for i in range(30)] + [f"http://{i}.net/bad" for i in range(30)]
    for one in ("http://0.com/good", "http://0.net/bad"):
        first = sorted(spark.createDataFrame([(u,) for u in urls], "url string").select("url", uf.F.xxhash64("url").alias("h")).collect(),
                       key=lambda r: r["h"])
        hot = next(r["url"] for r in first if r["url"].endswith(one[-4:]))
        model, _, _ = uf.train(labelled(spark, urls + [hot] * 500), sample_rows=40)
        assert model is not None


def test_many_suffixes_meet_the_rows_in_a_shuffle_join(spark, monkeypatch):
    urls = [f"http://a{i}.s{i % 40}/{('good', 'bad', 'x')[i % 3]}" for i in range(240)] + ["http://x.new/"] * 200
    rows = labelled(spark, urls)
    stats, share = uf.suffix_stats(rows)
    cols = ["page_id", "url", "suffix_share", "suffix_weight"]
    want = sorted(uf._with_suffix(rows, stats, share).select(cols).collect())
    monkeypatch.setattr(uf, "BROADCAST_SUFFIXES", 5)
    assert sorted(uf._with_suffix(rows, stats, share).select(cols).collect()) == want and len(want) == len(urls)


def test_no_python_in_the_plan(spark):
    plan = uf.judge(pages(spark, URLS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
