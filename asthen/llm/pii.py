"""Personal data: exact base rules, and contextual patterns bootstrapped from what they find."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asthen.llm.common import stored

#: Kinds, in the order that settles spans with one start.
KINDS = ("email", "ip", "card", "phone")
#: A pattern is used if it was met around this many different seeds or found identifiers ...
MIN_INSTANCES = 5
#: ... and its score, the mean confidence of all it was met around, is at least this.
MIN_SCORE = 0.8
#: Rounds in which patterns and instances score each other.
ROUNDS = 4

# Base rules, anchored so that no run of characters is tried from more than one place.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# What may be or begin an identifier: a word that begins with X or *, or has one of 0-9 @ : * [ (.
_WORD = re.compile(r"(?<!\S)(?:[^\s\w*@]*+[Xx*]|[^\s0-9@:*\[(]*+[0-9@:*\[(])\S*+")
# A word of a number, without the signs that may end it, and what else may stand up to a blank.
_NUMBER = re.compile(r"\(?[0-9Xx*](?:[().-]{0,3}[0-9Xx*]){0,40}+")
_TAIL = re.compile(r"[-.,;:!?\"'()\[\]{}<>]*+(?!\S)")
_BLANKS = re.compile(r"[().-]?  ?(?=\(?[0-9Xx*])")
_EDGE = ".,;:!?\"'()[]{}<>"
_SIGNS = frozenset("0123456789Xx*")
_LEAD = _EDGE.replace("(", "")
_SHAPES = {
    "ip": re.compile(r"(?:[0-9]{1,3}[.:-]){3}[0-9]{1,3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}"),
    "card": re.compile(r"(?:[0-9Xx*][ .-]?){12,19}"),
    "phone": re.compile(r"\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}"),
}


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            free = match.end()
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base matches, sorted; ends are exclusive."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() > 11:
            digits = re.sub("[ -]", "", m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def _context(text: str, start: int) -> str:
    """The two words before a place, lower-cased, without digits and edge signs."""
    words = text[max(0, start - 80) : start].split()[-2:]
    if start > 80 and words and not text[start - 80].isspace() and len(words) < 2:
        words = words[1:]
    cleaned = (re.sub("[0-9]+", "0", w.lower().strip(_EDGE)) for w in words)
    return " ".join(cleaned)


def _is_email(token: str) -> bool:
    """Text, one of @ [at] (at), text; without an @ besides."""
    if "@" in token:
        return token.count("@") == 1 and token[0] != "@" != token[-1]
    return any(0 < token.find(sign, 1) < len(token) - 4 for sign in ("[at]", "(at)"))


def _number_ends(text: str, start: int, stop: int, inside: bool) -> list[int]:
    """Ends of the number words from `start` on that lie before `stop`, while a number may go on;
    only of the first word if that is `inside` another number."""
    ends, at, signs = [], start, 0
    while signs < 19 and (word := _NUMBER.match(text, at)):
        if word.end() > stop or not _TAIL.match(text, word.end()):
            break
        ends.append(word.end())
        signs += sum(c in _SIGNS for c in word[0])
        blanks = None if inside else _BLANKS.match(text, word.end())
        if not blanks:
            break
        at = blanks.end()
    return ends


def _card_end(text: str, start: int, ends: list[int]) -> int | None:
    """A card number of one word ends there. Of others, one that passes Luhn's test, then one of
    equal groups, then the longest is taken, as other numbers may follow."""
    fits = [e for e in ends if _SHAPES["card"].fullmatch(text, start, e)]
    if not fits or fits[0] == ends[0]:
        return fits[0] if fits else None

    def rank(end: int) -> tuple[bool, bool, int]:
        digits = re.sub("[ .-]", "", text[start:end])
        groups = {len(w) for w in text[start:end].split()}
        return digits.isdecimal() and _luhn(digits), len(groups) == 1, end

    return max(fits, key=rank)


def _phone_end(text: str, start: int, ends: list[int]) -> int | None:
    """A phone number ends with a word that is joined by signs or is all of it, or with its tenth
    digit's word; numbers behind are others. A shorter one goes as far as it can."""
    end, last = None, start
    for e in ends:
        if _SHAPES["phone"].fullmatch(text, start, e):
            end = e
            word = text[last:e].strip(" ().-")
            if last == start or not word.isdigit() or sum(c.isdigit() for c in text[start:e]) >= 10:
                break
        last = e
    return end


def _candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, kind number, end) of the places with a kind's shape that touch no base span."""
    at, done = 0, 0
    for m in _WORD.finditer(text):
        word = m[0].lstrip(_LEAD)
        start = m.end() - len(word)
        token = word.rstrip(_LEAD)
        while at < len(base) and base[at][2] <= start:
            at += 1
        stop = base[at][0] if at < len(base) else len(text)
        if not token or start >= stop:
            continue
        end = start + len(token)
        if end <= stop:
            plain = token.lstrip(_EDGE)
            if plain and _is_email(plain):
                yield end - len(plain), 0, end
            if plain and _SHAPES["ip"].fullmatch(plain):
                yield end - len(plain), 1, end
        number = start + len(token) - len(token.lstrip("("))
        if number >= end or text[number] not in _SIGNS:
            continue
        # inside a number only what is whole by itself begins another
        inside = number < done
        ends = _number_ends(text, number, stop, inside)
        if not ends:
            continue
        card = _card_end(text, number, ends)
        phone = None
        if text[number] not in "Xx*":
            bracket = max(start, number - 1)
            phone = _phone_end(text, bracket, ends)
            # the first groups of a longer card number of equal groups aren't a phone number
            groups = {len(w) for w in text[number : card or number].split()}
            if phone and card and phone < card and len(groups) == 1 and phone not in ends[:1]:
                phone = None
        if card:
            yield number, 2, card
            done = max(done, card)
        if phone and not (inside and sum(c.isdigit() for c in token) < 10):
            yield bracket, 3, phone
            done = max(done, phone)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans, and every other place that has a kind's shape, with its context."""
    kind_of = pa.list_(
        pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64()), ("context", pa.string()),
                   ("instance", pa.string()), ("base", pa.bool_())])
    )
    for batch in batches:
        out = []
        for value in batch.column("text"):
            text = value.as_py() or ""
            base = base_spans(text)
            rows = [
                {"s": s, "k": k, "e": e, "context": _context(text, s), "instance": text[s:e].lower(),
                 "base": True}
                for s, k, e in base
            ]
            rows += [
                {"s": s, "k": k, "e": e, "context": _context(text, s), "instance": text[s:e].lower(),
                 "base": False}
                for s, k, e in _candidates(text, base)
            ]
            out.append(rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(out, kind_of)], names=["doc_id", "places"]
        )


def score_patterns(places: DataFrame) -> DataFrame:
    """(k, context, score) of the patterns to use, from (k, context, instance, base).

    Patterns and instances form a graph. Seeds, found by a base rule, have confidence 1 for
    good, others begin at 0. In each round a pattern's score is the mean confidence of the
    instances around which it was met, and another instance gets 1 minus the product of the
    doubts in its patterns. All sums are grouped; an edge counts once however often it occurs.
    All edges take part, as patterns without seeds score by the instances found so far;
    MIN_INSTANCES and MIN_SCORE only select from the last round.
    """
    edges = stored(
        places.where("context != ''")
        .groupBy("k", "context", "instance")
        .agg(F.max("base").alias("base"))
    )
    instances = edges.groupBy("k", "instance").agg(F.max(F.col("base").cast("double")).alias("c"))
    for _ in range(ROUNDS):
        scores = (
            edges.join(instances, ["k", "instance"])
            .groupBy("k", "context")
            .agg(F.avg("c").alias("score"), F.count("*").alias("n"))
        )
        doubt = F.sum(F.log1p(-F.least("score", F.lit(0.999999))))
        found = edges.join(scores, ["k", "context"]).groupBy("k", "instance")
        found = found.agg(doubt.alias("d"), F.max("base").alias("base"))
        instances = stored(
            found.select(
                "k", "instance", F.when(F.col("base"), 1.0).otherwise(1 - F.exp("d")).alias("c")
            )
        )
    return scores.where((F.col("score") >= MIN_SCORE) & (F.col("n") >= MIN_INSTANCES)).select(
        "k", "context", "score"
    )


def _digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of `docs`.

    Base rules find email addresses, IPv4 addresses, card numbers and phone numbers. They are
    the seeds of a bootstrap: the words before them induce patterns, which are scored with all
    instances of the corpus (`score_patterns`), and good patterns add the places of the same
    shape that no base rule accepts. Added spans never touch a base span, and of two added ones
    that overlap the first (then the kind listed first) is kept. Counts and base_sha256 are of
    base spans, `spans` has all. Texts are read once; only places of interest go on.

    A null text is empty: no spans, the checksum of the empty string. Rows with repeated or null
    keys each get their own row. Columns other than key and text are ignored; an empty table
    gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    place = "struct<s:long,k:int,e:long,context:string,instance:string,base:boolean>"
    scanned = stored(
        rows.mapInArrow(_scan, f"doc_id long, places array<{place}>").withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    places = scanned.select("row", F.explode("places").alias("p")).select("row", "p.*")
    patterns = score_patterns(places.select("k", "context", "instance", "base"))
    added = (
        places.where("not base")
        .join(patterns, ["k", "context"])
        .groupBy("row")
        .agg(F.collect_list(F.struct("s", "k", "e")).alias("added"))
    )
    base = F.transform(
        F.filter("places", lambda p: p["base"]), lambda p: F.struct(p["s"], p["k"], p["e"])
    )
    joined = scanned.select("doc_id", "row", base.alias("base")).join(added, "row", "left")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            out: list[list] = [[] for _ in names[1:]]
            for found, more in zip(batch.column("base").to_pylist(), batch.column("added").to_pylist()):
                spans = sorted((p["s"], p["k"], p["e"]) for p in found)
                kept, end = [], -1
                for s, k, e in sorted((p["s"], p["k"], p["e"]) for p in more or ()):
                    if s >= end:
                        kept.append((s, k, e))
                        end = e
                values = [sum(k == n for _, k, _ in spans) for n in range(len(KINDS))]
                values.append(hashlib.sha256(_digest(spans).encode()).hexdigest())
                values.append(_digest(sorted(spans + kept)))
                for column, value in zip(out, values):
                    column.append(value)
            types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, types))], names=names
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return joined.mapInArrow(
        digest, f"doc_id long, {counts}, base_sha256 string, spans string"
    ).withColumnRenamed("doc_id", key)
