import re

import pytest

from lapengine.llm import url_filter as U
from lapengine.llm.registry import QUERIES, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return U.train(U.labelled_urls(spark))


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule(host, path):
    fit = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


URLS = [None, "", "no scheme", "http://", "https://NET/x", "http://a.net", "http://a.net/", "http://xnet/", "http://example.net/en/1",
        "http://sub.EXAMPLE.net/en/", "http://example.net/en", "http://example.com/de/1?x=/en/", "http://a.org/fr/", "http://a.org/fr",
        "http://É.org/fr/ß#x", "a://b://c/d", "http://h?p=/x", "http://h#f/x", "http://a.net\n/x/", "http://" + "a" * 5000 + ".com/" + "b/" * 5000]


def test_rules_and_parts(spark, model):
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, rule string")
    got = U.judge(df, model).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path = parts((URLS * 2)[r.page_id])
        want = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, want and want.name)
        assert r.verdict == (want.verdict if want else "block" if r.probability >= 0.5 else "allow")
    assert U.judge(df.limit(0), model).collect() == []
    assert [r.verdict for r in got if (URLS * 2)[r.page_id] is None] == ["allow"] * 2


def test_model_separates_held_out_urls(spark, model):
    bad = ["https://ads.example.com/banner/3", "http://www.click-track.example.org/redirect", "http://m.ads-track.example.com/en/31366"]
    good = ["https://tionsh.example.com/en/23201", "http://blog.ththth.example.org/de/40677.html", "http://docs.example.com/guide/x"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(bad + good)], "page_id long, url string")
    p = {r.page_id: r.probability for r in U.judge(df, model, rules=()).collect()}
    assert min(p[i] for i in range(3)) > 0.5 > max(p[i] for i in range(3, 6)), p


def test_query(spark):
    pages = {r.page_id: r.url for r in table(spark, SF, "pages").collect()}
    got = QUERIES["op5_url_filter"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path = parts(pages[r.page_id])
        want = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, want and want.name)
        assert r.verdict == want.verdict if want else r.verdict in ("allow", "block")
