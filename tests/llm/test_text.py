"""Personal data, toxicity, extraction, url filter and pipeline on small tables with awkward rows."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from asthen.llm import extraction, htmltrain, toxicity, urls
from asthen.llm.pii import _candidates, base_spans, find_pii, score_patterns

KINDS = ["email", "ip", "card", "phone"]


def brute_spans(text):
    """The contract's patterns as they are written."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_rules_equal_the_plain_patterns():
    rng = random.Random(1)
    parts = ["a@b", ".com", "@", "x.y", "+1", " 319 555", "-", "(", ")", "1", "4111 1111 1111 1111",
             "255", ".", "..", " ", "é", "256.1.1.1", "1.2.3.4", "+49 30 1234567", "%+-", "0", "\n",
             "00000255.1.1.1", "a@-.-", "@@", "4111-1111-1111-1111-"]
    for _ in range(6000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert base_spans(text) == brute_spans(text), text


def test_ip_parts_may_have_any_number_of_zeros():
    assert base_spans("0" * 5000 + ".1.1.1") == [(0, 1, 5006)]
    assert base_spans("0" * 5000 + "256.1.1.1") == []


def test_base_rules_are_linear_in_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000,
                 "1 " * 200_000, "+1" + "(" * 300_000, "@" * 300_000):
        base_spans(text)


def test_find_pii(spark):
    rng = random.Random(3)

    def word():
        return "".join(rng.choices("abcdefgh", k=5))

    texts = []
    for i in range(60):  # seeds: a phone number behind the same two words
        texts.append(f"{word()} {word()} call me +1 (319) 555-{1000 + i} {word()} 7 {word()}")
    texts += [f"{word()} call me 319-555-{2000 + i} now" for i in range(5)]  # no base rule takes these
    texts += [f"{word()} {word()} 319-555-{3000 + i} now" for i in range(5)]  # no pattern
    texts += [None, "", "mail a@b.de and 1.2.3.4, é 4111 1111 1111 1111", "call me 7"]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "a@b.de", "x", 1), (0, texts[0], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, row int")
    got = find_pii(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = (texts[r.doc_id] or "") if r.doc_id is not None else "a@b.de"
        spans = brute_spans(text)
        digest = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(k == j for _, k, _ in spans) for j in range(4)]
        if r.doc_id in range(60, 65):
            at = text.index("319")
            assert r.spans == f"phone:{at}:{at + 12}"
        else:
            assert r.spans == digest
    assert find_pii(docs.limit(0)).collect() == []


@pytest.mark.parametrize("text, want", [
    ("call me 319-555-1234 2024 12 now", "phone 319-555-1234"),
    ("call me 319-555-1234 20 times", "phone 319-555-1234"),
    ("call me (319) 555-1234 20 times", "phone (319) 555-1234"),
    ("call me 319 555 1234 20 times", "phone 319 555 1234"),
    ("call me 0800 123 4567 now", "phone 0800 123 4567"),
    ("call me 2024 319-555-1234.", "phone 319-555-1234"),
    ("pay by 4111 1111 1111 1111 20 times", "card 4111 1111 1111 1111"),
    ("pay by 4111-1111-1111-1112 2024", "card 4111-1111-1111-1112"),
    ("pay by XXXX XXXX XXXX 1234, please", "card XXXX XXXX XXXX 1234"),
    ("pay by ****-****-****-1234.", "card ****-****-****-1234"),
    ("mail john[at]example.com now", "email john[at]example.com"),
    ("mail (john(at)example.com), now", "email john(at)example.com"),
    ("from dead:beef::cafe on", "ip dead:beef::cafe"),
])
def test_candidates_end_where_the_identifier_does(text, want):
    base = base_spans(text)
    assert not base
    assert want in {f"{KINDS[k]} {text[s:e]}" for s, k, e in _candidates(text, base)}


def test_candidates_are_linear_in_long_runs():
    for text in ("[at]" * 100_000 + "@", "1 " * 100_000, "1" * 300_000, "(" * 300_000, "X " * 50_000,
                 "1-" * 200_000, "1." + "." * 300_000, "* " * 50_000, "((1) " * 50_000):
        list(_candidates(text, []))


def test_patterns_score_by_found_instances(spark):
    rows = [(3, "call me", f"+1 319 555 {1000 + i}", True) for i in range(50)]
    rows += [(3, c, f"319-555-{i}", False) for i in range(2000, 2008) for c in ("call me", "reach her")]
    rows += [(3, "reach her", f"319-555-{i}", False) for i in (2008, 2009)]  # only by the second generation
    rows += [(3, "ring at", f"+1 319 555 {1000 + i}", True) for i in range(4)]  # four seeds and eight found
    rows += [(3, "ring at", f"319-555-{i}", False) for i in range(2000, 2008)]
    rows += [(3, "few of", f"+1 319 555 {1000 + i}", True) for i in range(4)]  # too few of both
    rows += [(3, "none of", f"319-556-{i}", False) for i in range(1000, 1020)]
    rows += [(2, "reach her", f"319-555-{i}", False) for i in range(2000, 2008)]  # kinds are apart
    places = spark.createDataFrame(rows * 2, "k int, context string, instance string, base boolean")
    got = {(r.k, r.context) for r in score_patterns(places).collect()}
    assert got == {(3, "call me"), (3, "reach her"), (3, "ring at")}


def test_toxicity_by_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("score", F.lit(1))
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    more = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = toxicity.toxicity(more, labels).toPandas().set_index("doc_id")
    assert len(got) == more.count()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in got.held_out.items())
    known = got.join(labels.toPandas().set_index("doc_id"))
    held = known[known.held_out & known.toxic.notna()]
    hit = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert hit >= 0.7 * (held.toxic == 1).sum()
    assert ((held.predicted == 1) & (held.toxic == 0)).sum() <= 0.02 * len(held)
    # labels of held-out rows are not learned from
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    some = docs.limit(50)
    model, other = (toxicity.learn(more, x) for x in (labels, flipped))
    assert (model.weights == other.weights).all() and model.bias == other.bias
    assert toxicity.toxicity(some, labels.limit(0)).select("score").distinct().count() == 1


def test_toxicity_of_awkward_rows(spark):
    rows = [(i, "you stupid fool " * 3 if i % 2 else "a calm and quiet day", 1, 2) for i in range(60)]
    labels = spark.createDataFrame([(r[0], r[0] % 2) for r in rows] + [(None, 1), (5, 0), (7, 9)], "doc_id long, toxic int")
    rows += [(100, None, 1, 2), (101, "", 1, 2), (None, "you stupid fool", 1, 2), (101, "", 1, 2),
             (102, "a calm and quiet day " * 80_000 + "you stupid fool", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, score int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[None].predicted == 1 and by[2].predicted == 0 and by[100].score == by[101].score
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in got)


def test_n_grams_do_not_depend_on_chunks(monkeypatch):
    import numpy as np

    found = np.zeros(1 << toxicity.BITS, bool)
    text = "Some text\twith é and " * 40
    want = toxicity.places(text, found).tolist()
    monkeypatch.setattr(toxicity, "CHUNK", 32)
    assert toxicity.places(text, found).tolist() == want and not found.any()


@pytest.fixture(scope="module")
def field():
    return extraction.fit(htmltrain.labelled_pages())


def test_extraction_on_held_out_layouts(field):
    blocks = wrong = 0
    for page in htmltrain.labelled_pages(200, seed=77):
        found = extraction.blocks(page)
        blocks += len(found)
        wrong += sum(a != b.main for a, b in zip(field.main(found), found))
    assert wrong <= 0.02 * blocks


def test_extraction_of_one_page(field):
    page = """<html><head><title>No</title><style>p{}</style></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav>
    <div class="cookie-notice">We use cookies.</div>
    <article><h1>A &amp; title</h1><p>First,\n  with <b>bold</b>&nbsp;text.
    <p>Second <script>var x = "</p>";</script>part<br>here.</p><div class="ad">Buy this now.</div>
    <ul><li>One item.<li>Two items.</ul></article>
    <section id="comments"><h3>Comments</h3><div class="comment"><p>I like it a lot.</p></div></section>
    <aside class=sidebar><p>Read more here.</p></aside><form><label>Mail</label><input></form>
    <footer>&copy; site</footer>"""
    assert extraction.main_text(field, page).split("\n") == [
        "A & title", "First, with bold text.", "Second part here.", "One item.", "Two items."
    ]


def test_viterbi_is_the_best_of_all_labellings(field):
    from itertools import product

    page = extraction.blocks(htmltrain.labelled_pages(1, seed=5)[0])[:9]
    emit = [sum(field.weights.get(f, 0) for f in fs) for fs in extraction.features(page)]

    def score(labels):
        return sum(e for e, y in zip(emit, labels) if y) + sum(field.steps[a, b] for a, b in zip(labels, labels[1:]))

    best = max(product((0, 1), repeat=len(page)), key=score)
    assert math.isclose(score(best), score([int(x) for x in field.main(page)]))


def test_extract_rows(spark):
    rows = [(1, "u", "<article><p>Some text, and more of it.</p></article>", 1), (2, None, None, 1),
            (3, "u", "", 1), (None, "u", "<p", 1), (1, "u", "<!-- x", 1), (4, "u", "<script>", 1),
            (5, "u", "<article>" + "<p>Long, long, long text. </p>" * 20_000 + "</article>", 1),
            (6, "u", "<div " + "a='" * 50_000, 1), (7, "u", "</b>" * 1000 + "<b>" * 3000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extraction.extract(pages).collect()
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got if r.page_id != 1}
    assert by[2] == by[3] == by[4] == by[6] == by[7] == ""
    assert by[5].count("\n") == 19_999
    assert "Some text, and more of it." in [r.text for r in got if r.page_id == 1]
    assert extraction.extract(pages.limit(0)).collect() == []


def test_extraction_of_pages(spark):
    """Article text as it stands in the page's source."""
    import html as escapes

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (re.sub("<[^>]+>", " ", p) for p in re.split(r"</?p>|</?h1>", body))
        parts = [" ".join(escapes.unescape(p).split()) for p in parts]
        assert got[r.page_id] == "\n".join(p for p in parts if p)


RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fits = []
    for _, rule in RULES:
        site, rest = rule.split("/", 1)
        if (host == site or host.endswith("." + site)) and path.startswith("/" + rest):
            fits.append(rule)
    return max(fits, key=len, default=None)


def test_urls(spark):
    given = [None, "", "no scheme", "http://", "http://Blog.EXAMPLE.net/en/1?x://y", "https://a.net",
             "https://net/x", "https://planet/x", "http://x.example.com/de/", "http://x.example.com/de",
             "http://x.org/fr/2#a", "http://cheappills.example.com/buy", "http://a://b/c",
             "http://citynews.example.com/history", "http://x.example.com/\n/é?q", "http://a.com:80/de",
             "http://" + "pills" * 3000 + ".com/", "http://freebets.example.com/", "http://É.NET/x"]
    rows = [(i, u, "<p>city news city news city news", 1) for i, u in enumerate(given)]
    rows += [(None, given[4], None, 1), (4, given[4], "", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule int")
    got = urls.filter_urls(pages, pages, RULES).collect()
    assert len(got) == len(rows)
    verdicts = dict((r, v) for v, r in RULES)
    for r in got:
        url = given[r.page_id] if r.page_id is not None else given[4]
        host, path = brute_parts(url)
        assert (r.host, r.path) == (host, path)
        assert r.rule == brute_rule(host, path)
        if r.rule:
            assert r.verdict == verdicts[r.rule]
        else:
            assert r.verdict == ("block" if r.score > 0 else "allow")
    by = {r.page_id: r.verdict for r in got}
    assert by[11] == by[16] == by[17] == "block" and by[0] == by[13] == by[15] == "allow"
    assert urls.filter_urls(pages.limit(0), pages, RULES).collect() == []
    assert urls.filter_urls(pages, pages.limit(0)).count() == len(rows)


def test_segmentation_is_the_best_of_all_splits():
    counts = {"cheap": 9, "pills": 7, "pill": 5, "s": 50, "che": 3, "ap": 3, "new": 20, "news": 9}

    def splits(name):
        yield [name]
        for i in range(1, len(name)):
            for rest in splits(name[i:]):
                yield [name[:i], *rest]

    def score(words):
        return sum(
            math.log(counts[w] / 1000) if w in counts else -math.log(1000) - 2.3 * len(w) - 2 for w in words
        )

    for name in ("cheappills", "newscheap", "xpillsx", "s", "newpill", "zzz"):
        got = urls.segment(name, counts, 1000)
        assert "".join(got) == name
        assert math.isclose(score(got), max(map(score, splits(name))))
    assert urls.segment("cheappills", counts, 1000) == ["cheap", "pills"]


def test_long_varied_clean_texts_switch_on_no_other_feature():
    import numpy as np

    rng = random.Random(11)
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(150_000))
    # no n-gram of the text has a digit, and each of these shares its place with one that has none
    taken = np.zeros(1 << toxicity.BITS, bool)
    taken[toxicity.places(text, np.zeros(1 << toxicity.BITS, bool))] = True
    other = np.concatenate([k for k in toxicity._keys("".join(rng.choices("0123456789", k=30_000)))])
    other = np.unique(other[taken[toxicity._place(other)]])
    assert len(other) > 1000
    model = toxicity.Model(other, np.ones(len(other)), -5.0)
    assert model.score(text, toxicity.Features(other)) < 0.01
    own = np.unique(np.concatenate(list(toxicity._keys("some clean words"))))
    both = toxicity.Features(np.union1d(other, own))
    assert (both.keys[both.of("Some CLEAN\twords")] == own).all() and not both.found.any()


def test_pipeline_stages(spark):
    """Each stage does to its input what its operator says, and nothing else."""
    import corpus_pipeline as p
    from asthen.llm.common import stored, table
    from asthen.llm.decontamination import contained_items
    from asthen.llm.linededup import dedup_lines
    from asthen.llm.packing import pack
    from asthen.llm.simhash import simhash_components

    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    stages = dict(p.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "packing"]
    steps = [docs]
    for f in stages.values():
        steps.append(stored(f(spark, steps[-1], folder)))
    for step in steps[1:-1]:
        assert step.columns == docs.columns

    def by_id(df, *columns):
        return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *columns).collect()}

    scores = by_id(toxicity.toxicity(docs, table(spark, folder, "labels")), "predicted")
    assert set(by_id(steps[1])) == {i for i, (x,) in scores.items() if not x}
    assert by_id(steps[2], "text", "lang") == {
        i: (t, lang) for i, (t, lang) in by_id(dedup_lines(steps[1]), "text", "row.lang").items()
    }
    assert all(n == len(t) for t, n in by_id(steps[2], "text", "n_chars").values())
    groups = by_id(simhash_components(steps[2]), "component_id")
    assert set(by_id(steps[3])) == {c for (c,) in groups.values()}
    found = set(by_id(contained_items(steps[3], table(spark, folder, "benchmark"))))
    assert set(by_id(steps[4])) == set(by_id(steps[3])) - found
    tokenizer = p.public_tokenizers.path("byte_bpe_50k.json")
    assert sorted(map(tuple, steps[5].collect())) == sorted(map(tuple, pack(steps[4], tokenizer).collect()))
    assert p.run(spark, folder).count() == steps[5].count()


def test_pipeline_of_awkward_rows(spark, tmp_path):
    import corpus_pipeline as p

    rows = [(1, "some words " * 50, "en", "s", 5), (1, "some words " * 50, "en", "s", 5), (2, None, None, None, None),
            (3, "", "en", "s", 0), (None, "unlike all others here", "en", "s", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for folder, data in ((tmp_path / "some", rows), (tmp_path / "none", [])):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert p.run(spark, str(tmp_path / "none")).count() == 0
    got = p.run(spark, str(tmp_path / "some")).collect()
    assert {r.doc_id for r in got} == {None, 1, 2}
