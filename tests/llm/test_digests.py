"""Sharding, packing and SimHash against brute force on small tables with awkward rows."""

import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from asthen.llm.packing import BestFit, pack
from asthen.llm.sharding import shard_by_bytes
from asthen.llm.simhash import GrayTree, simhash_components

PATH = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(9000))
TEXTS = [
    "the quick brown fox jumps over the lazy dog",
    "The Quick brown\tfox jumps  over the lazy dog",
    None,
    "",
    "  \n ",
    "one",
    "one two",
    LONG,
    LONG + " end",
    "<|endoftext|> é 漢字 текст   x",
    "a b c d e f g h",
    "a b c d e f g h",
]


@pytest.fixture()
def docs(spark):
    rows = [(i, t, "x", 1, 2, 3) for i, t in enumerate(TEXTS)] + [(3, "", "x", 1, 2, 3)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, key string, size int, fp int, part int"
    )


def brute_print(text, words=3):
    tokens = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        tokens = tokens.replace(c, " ")
    tokens = [t for t in tokens.split(" ") if t]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def brute_components(prints):
    ids = list(prints)
    comp = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (prints[i] ^ prints[j]).bit_count() <= 2 and comp[j] < comp[i]:
                    comp[i], changed = comp[j], True
    return comp


def test_simhash_components(docs):
    got = simhash_components(docs).collect()
    prints = {i: brute_print(t) for i, t in enumerate(TEXTS)}
    comp = brute_components(prints)
    assert len(got) == len(TEXTS) + 1
    for row in got:
        assert int(row.fingerprint, 16) == prints[row.doc_id]
        assert row.component_id == comp[row.doc_id]


def test_simhash_on_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in simhash_components(rows).collect()}
    prints = {r.doc_id: brute_print(r.text) for r in rows.collect()}
    comp = brute_components(prints)
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == comp


def test_simhash_of_nothing(docs):
    assert simhash_components(docs.limit(0)).collect() == []


def test_simhash_links_planted_distances(spark):
    from asthen.llm.simhash import link_fingerprints

    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    near = [
        int(b) ^ sum(1 << int(k) for k in rng.choice(64, d, replace=False))
        for b, d in zip(np.repeat(base[:60], 4), list(range(1, 5)) * 60)
    ]
    dense = [int(base[0]) ^ (i * 2654435761 % 4096) for i in range(700)]
    prints = dict(enumerate([int(b) for b in base] + near + dense))
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    got = link_fingerprints(spark.createDataFrame(rows, "doc_id long, fp long"))
    got = {r.fp: r.component_id for r in got.collect()}
    comp = brute_components(prints)
    assert all(got[fp] == comp[i] for i, fp in rows)


def test_gray_tree_equals_all_pairs():
    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(0, 2**14, 900, dtype=np.uint64))
    a, b = GrayTree(prints).near(prints, 2)
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(apart <= 2))))


def check_pack(rows, texts, window=2048):
    tokenizer = Tokenizer.from_file(PATH)
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            part = ids[at : at + r.length]
            assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    assert sorted(sequences) == list(range(len(sequences)))


def test_pack(docs):
    once = docs.where("not (doc_id = 3 and part = 3 and text is null)").dropDuplicates(["doc_id"])
    check_pack(pack(once, PATH).collect(), dict(enumerate(TEXTS)))
    assert pack(docs, PATH).count() == pack(once, PATH).count() + 1
    assert pack(docs.limit(0), PATH).collect() == []


def test_pack_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = pack(rows, PATH).collect()
    check_pack(got, {r.doc_id: r.text for r in rows.collect()})
    used = sum(r.length for r in got)
    assert used / (2048 * len({r.sequence_id for r in got})) > 0.97


def test_best_fit_takes_the_tightest_window():
    fit, rng, free = BestFit(100), np.random.default_rng(1), {}
    for n in sorted(rng.integers(1, 100, 500).tolist(), reverse=True):
        fits = [c for c in free.values() if c >= n]
        window, offset = fit.put(n)
        if fits:
            assert free[window] == min(fits) and offset == 100 - min(fits)
            free[window] -= n
        else:
            assert window not in free and offset == 0
            free[window] = 100 - n


def test_shards(docs):
    got = shard_by_bytes(docs, shards=4).collect()
    texts = [*TEXTS, ""]
    assert len(got) == len(texts)
    for r in got:
        body = (TEXTS[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(body) + 1, zlib.crc32(body))
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in order] == sorted(r.doc_id for r in got)
    for s in range(4):
        assert [r.slot for r in order if r.shard == s] == list(
            range(sum(r.shard == s for r in got))
        )
    assert shard_by_bytes(docs.limit(0)).collect() == []


def test_shards_are_balanced(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = shard_by_bytes(rows).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 16
    assert sums.max() - sums.min() <= 2 * got["size"].max()


def test_both_token_loops_give_the_same_ids():
    import random

    from asthen.llm.packing import encoder

    encode, slow = encoder(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(6)
    chars = [chr(c) for c in range(0x250)] + list("  \n\t'smtdrelv0123") * 12 + ["<|endoftext|>", "漢", " "]
    for _ in range(3000):
        text = "".join(rng.choices(chars, k=rng.randint(0, 40)))
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids, repr(text)
