"""The url classifier: names it was not trained on, and its score against a direct computation."""

import math
import re
from collections import Counter

from asthen.llm import urls

SF = "/root/testdata/sf0.1"
TELLING = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def test_sites_that_the_training_list_does_not_hold(spark):
    """The names that tell in the given pages are in no training url, apart or run together."""
    listed = " ".join(urls.BLOCKED + urls.ALLOWED)
    assert not [n for n in TELLING if n in listed or n.replace("-", "") in listed]
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = urls.filter_urls(pages, pages).select("host", "verdict").collect()
    telling = [r for r in got if any(n in r.host for n in TELLING)]
    other = [r for r in got if not any(n in r.host for n in TELLING)]
    assert len({n for r in telling for n in TELLING if n in r.host}) == len(TELLING)
    recall = sum(r.verdict == "block" for r in telling) / len(telling)
    false = sum(r.verdict == "block" for r in other) / len(other)
    assert recall >= 0.8 and false <= 0.01, (recall, false)


def names(url):
    host, _, path = url.partition("/")
    return [n for n in re.split(r"[^a-z]+", f"{host.rpartition('.')[0]}/{path}") if len(n) > 1]


def test_score_is_that_of_naive_bayes(spark):
    blocked = ["cheap-pills.com/buy", "cheappills.net/buy", "pillsnow.biz/order"]
    allowed = ["city-news.com/world", "newsroom.org/city", "weather.net/today", "worldnews.info/city"]
    texts = ["cheap city news room now today world " * 9, "<p>weather pills</p> order buy " * 7]
    pages = [(i, u, t) for i, (u, t) in enumerate([
        ("http://citypills.com/buy/now", texts[0]), ("http://www.newsworld.org/today?x=pills", texts[1]),
        ("https://cheapcheap.net/", None), ("http://zzz.org/", ""), ("nothing", ""), (None, "")])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    counts = Counter(w for t in texts for w in re.split(r"[^a-z]+", re.sub("<[^>]*>", " ", t)) if 2 <= len(w) <= 20)
    total = sum(n for n in counts.values() if n >= urls.MIN_COUNT) + 1_000_000
    counts = {w: n for w, n in counts.items() if n >= urls.MIN_COUNT}
    for word, n in urls.seed_words(blocked + allowed).items():
        counts[word] = counts.get(word, 0) + n
    seen = [Counter(t for u in group for n in names(u) for t in urls.segment(n, counts, total)) for group in (blocked, allowed)]
    every = set(seen[0]) | set(seen[1])
    sizes = [sum(c.values()) + len(every) for c in seen]

    def score(host, path):
        tokens = [t for n in re.split(r"[^a-z]+", f"{host}/{path}") if len(n) > 1 for t in urls.segment(n, counts, total)]
        return math.log(3 / 4) + sum(
            math.log((seen[0][t] + 1) / sizes[0]) - math.log((seen[1][t] + 1) / sizes[1]) for t in tokens if t in every)

    got = {r.page_id: r for r in urls.filter_urls(df, df, blocked=blocked, allowed=allowed).collect()}
    for i in range(6):
        assert abs(got[i].score - score(got[i].host, got[i].path)) < 1e-6, (i, got[i])
        assert got[i].verdict == ("block" if got[i].score > 0 else "allow")
    assert got[0].verdict == "block" and got[1].verdict == "allow"
