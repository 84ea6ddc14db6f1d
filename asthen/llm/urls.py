"""URL filter: names are split into words by unigram Viterbi, words are scored by naive Bayes."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asthen.llm.common import stored

#: Letters of a word in a name, at most; longer runs are split.
LONGEST = 20
#: Occurrences a word needs in the corpus to count as one.
MIN_COUNT = 3
#: Lists of rules, (verdict, rule): a host, with its subdomains, and the beginning of a path.
Rules = tuple[tuple[str, str], ...]

#: Urls that the classifier is trained on (fixed values), the scheme left out.
BLOCKED = """
discount-pills.com/buy/viagra cheaptablets.net/order cheapmeds.org/pharmacy/discount pillsonline.biz/viagra
buypills.info/cheap online-pharmacy.com/cialis viagrasale.net/cheap royal-casino.com/slots
casinostar.net/bonus bestcasino.org/jackpot online-casino.biz/roulette luckyslots.com/casino
best-bets.com/odds livebets.net/free sportsbets.org/betting betting-tips.com/win pokerwin.net/poker
winbig.biz/lottery jackpotcity.com/slots spam-links.com/links seospam.net/farm linkfarm.org/spam
buy-links.biz/seo spamlinks.info/farm clickfarm.net/traffic adult-movies.com/videos adultclips.net/porn
xxxvideos.org/sex freeporn.biz/adult hotsex.info/xxx nudecams.com/live adultcams.net/sex
ads-click.com/click clickads.net/pixel adtracker.org/banner trackclicks.biz/ads popads.info/click
adserver.com/banner clicktrack.net/redirect fast-loans.com/payday payday-loan.net/cash
easycash.biz/loans crack-keygen.com/warez warezcrack.net/serial freekeygen.org/torrent
replica-watches.com/cheap fakewatches.net/replica get-rich.biz/money earnmoney.info/fast
miracle-diet.com/weight weightloss-pills.net/diet malware-host.com/exe phish-login.net/verify
""".split()
ALLOWED = """
city-news.com/world dailynews.net/politics newsroom.org/article localnews.info/weather
morningpost.com/culture history-blog.org/post travelblog.com/europe cookingblog.net/recipes
foodrecipes.org/dinner gardenblog.info/plants science-journal.org/research openscience.net/paper
university.org/library statelibrary.net/catalog publiclibrary.info/books bookreview.com/novel
booksellers.org/shop musicschool.net/lessons highschool.org/students schoolboard.info/calendar
healthcare.org/clinic hospital.net/doctors museum.org/exhibition artgallery.com/paintings
weather-report.com/forecast localweather.net/today football-club.org/match sportsnews.com/results
software-docs.org/manual opensource.net/code developer.org/guide webdesign.com/portfolio
photo-studio.com/wedding familytree.net/history chesspuzzles.org/daily wildlife.org/birds
cityhall.net/services government.org/law parliament.info/debate charity.org/volunteer
railway.net/timetable airport.com/flights hotelguide.net/rooms campground.org/map
bakery.com/menu coffeehouse.net/about furniture.com/kitchen hardware.net/tools bikeshop.org/repair
knitting.info/patterns astronomy.org/stars physics.net/lecture languages.org/grammar dictionary.com/words
""".split()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path of a url; both empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    tail = F.substr(url, F.length(rest) + 4)
    host = F.regexp_extract(tail, r"^[^/?#]*", 0)
    after = F.substr(tail, F.length(host) + 1)
    path = F.regexp_extract(after, r"^[^?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule whose host is the url's or above it, and whose path begins the url's."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        site, slash, rest = rule.partition("/")
        fits = ((host == site) | F.endswith(host, F.lit("." + site))) & F.startswith(
            path, F.lit(slash + rest)
        )
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def names(host: Column, path: Column) -> Column:
    """Runs of letters of host and path, lower-cased, with repeats."""
    return F.filter(
        F.split(F.lower(F.concat_ws("/", host, path)), r"[^\p{L}]+"), lambda n: F.length(n) > 1
    )


def lexicon(texts: DataFrame, column: str) -> DataFrame:
    """(word, n): how often each word occurs in all texts; markup between < and > is left out."""
    plain = F.regexp_replace(F.lower(column), "<[^>]*+>", " ")
    words = texts.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word"))
    return (
        words.where(F.length("word").between(2, LONGEST))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= MIN_COUNT)
    )


def segment(name: str, counts: dict[str, int], total: float) -> list[str]:
    """The most likely split of a name under a unigram model; unknown words cost by length."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        options = []
        for start in range(max(0, end - LONGEST), end):
            word = name[start:end]
            n = counts.get(word)
            p = math.log(n / total) if n else -math.log(total) - 2.3 * len(word) - 2
            options.append((best[start][0] + p, start))
        best.append(max(options))
    out, end = [], len(name)
    while end:
        start = best[end][1]
        out.append(name[start:end])
        end = start
    return out[::-1]


def segmented(found: DataFrame, words: DataFrame, seeds: dict[str, int], total: float) -> DataFrame:
    """(name, tokens) for distinct names: each is joined with the words that occur in it.

    All substrings of the names meet the lexicon in a join, so the lexicon is never held in one
    place; a task sees one name and its own words at a time.
    """
    size = F.length("name")
    parts = found.select(
        "name", F.explode(F.sequence(F.lit(1), size)).alias("at"), size.alias("size")
    ).select(
        "name",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.col("size") - F.col("at") + 1)),
                lambda n: F.substring(F.col("name"), F.col("at"), n),
            )
        ).alias("word"),
    )
    known = parts.distinct().join(words, "word").groupBy("name").agg(
        F.map_from_entries(F.collect_set(F.struct("word", "n"))).alias("counts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = []
            for name, counts in zip(batch.column("name").to_pylist(), batch.column("counts").to_pylist()):
                mine = {w: n for w, n in seeds.items() if w in name}
                for w, n in counts or ():
                    mine[w] = mine.get(w, 0) + n
                tokens.append(segment(name, mine, total))
            yield pa.RecordBatch.from_arrays(
                [batch.column("name"), pa.array(tokens, pa.list_(pa.string()))], names=["name", "tokens"]
            )

    return found.join(known, "name", "left").mapInArrow(run, "name string, tokens array<string>")


def _words(url: str) -> list[str]:
    host, _, path = url.partition("/")
    kept = host.rpartition(".")[0] + "/" + path  # the last part of a host tells nothing
    return [n for n in "".join(c if c.isalpha() else " " for c in kept).split() if len(n) > 1]


def log_odds(tokens: dict[str, list[str]], blocked: list[str], allowed: list[str]) -> tuple[dict[str, float], float]:
    """Multinomial naive Bayes: the log-odds of each token for `block`, and of the classes."""
    seen = [Counter(t for u in urls for n in _words(u) for t in tokens[n]) for urls in (blocked, allowed)]
    vocabulary = set(seen[0]) | set(seen[1])
    sizes = [sum(c.values()) + len(vocabulary) for c in seen]
    odds = {
        t: math.log((seen[0][t] + 1) / sizes[0]) - math.log((seen[1][t] + 1) / sizes[1])
        for t in vocabulary
    }
    return odds, math.log(len(blocked) / len(allowed))


#: Occurrences that a word of the training urls' hyphenated names counts for in the lexicon.
SEED_COUNT = 200


def seed_words(urls: list[str]) -> dict[str, int]:
    """Words known from the training list: the parts of names with a hyphen, and path names."""
    out = set()
    for url in urls:
        host, _, path = url.partition("/")
        if "-" in host:
            out.update(n for n in host.rpartition(".")[0].split("-") if len(n) > 1)
        out.update(_words("./" + path))
    return dict.fromkeys(sorted(out), SEED_COUNT)


def filter_urls(
    urls: DataFrame,
    corpus: DataFrame,
    rules: Rules = (),
    key: str = "page_id",
    url: str = "url",
    text: str = "html",
    blocked: list[str] = BLOCKED,
    allowed: list[str] = ALLOWED,
) -> DataFrame:
    """(key, host, path, rule, verdict, score) for every row of `urls`.

    The verdict is that of the longest matching rule, or else of naive Bayes over the words of
    host and path: `block` if the log-odds `score` is above 0. Words are counted in the column
    `text` of all of `corpus`; every distinct name of a host or path is split with them
    once. Only tokens of the training list can move a score, so urls that have none of these in their names
    need no join; the others are joined by distinct (host, path).

    A null url, or one without `://`, has an empty host and path, no rule, and the verdict of the
    class odds alone, `allow`. Rows that repeat are judged alike and all returned, null keys
    too. Null texts count no words. Other columns are ignored; an empty table gives no rows.
    """
    spark: SparkSession = urls.sparkSession
    host, path = host_and_path(F.col(url))
    rows = urls.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    rows = stored(rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules)))
    words = stored(lexicon(corpus, text))
    total = float((words.agg(F.sum("n")).first()[0] or 0) + 1_000_000)
    seeds = seed_words(blocked + allowed)
    own = sorted({n for u in blocked + allowed for n in _words(u)})
    listed = spark.createDataFrame([(n,) for n in own], "name string")
    sites = rows.select("host", "path").distinct()
    each = sites.select(F.explode(F.array_distinct(names(F.col("host"), F.col("path")))).alias("name"))
    found = stored(each.union(listed).distinct())
    split = stored(segmented(found, words, seeds, total))
    trained = split.join(F.broadcast(listed), "name", "left_semi").collect()  # the training list's
    odds, prior = log_odds({r.name: r.tokens for r in trained}, blocked, allowed)
    value = spark.createDataFrame(sorted(odds.items()), "token string, odds double")
    scores = (
        split.select("name", F.explode("tokens").alias("token"))
        .join(F.broadcast(value), "token")  # the training list's vocabulary
        .groupBy("name")
        .agg(F.sum("odds").alias("odds"))
    )
    some = "|".join(sorted(odds))
    telling = F.filter(names(F.col("host"), F.col("path")), lambda n: n.rlike(some))
    asked = stored(sites.withColumn("names", telling).where(F.size("names") > 0))
    judged = (
        asked.select("host", "path", F.explode("names").alias("name"))
        .join(scores, "name")
        .groupBy("host", "path")
        .agg(F.sum("odds").alias("odds"))
    )
    marked = rows.withColumn("told", F.size(F.filter(names(F.col("host"), F.col("path")), lambda n: n.rlike(some))) > 0)
    scored = (
        marked.where("told")
        .join(judged, ["host", "path"], "left")
        .unionByName(marked.where("not told").withColumn("odds", F.lit(0.0)))
    )
    score = F.round(F.coalesce("odds", F.lit(0.0)) + F.lit(prior), 9)
    verdict = F.element_at(
        F.create_map(*[F.lit(x) for v, r in rules for x in (r, v)]), F.col("rule")
    ) if rules else F.lit(None).cast("string")
    by_words = F.when(score > 0, "block").otherwise("allow")
    return scored.select(
        F.col("key").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce(verdict, by_words).alias("verdict"),
        score.alias("score"),
    )
