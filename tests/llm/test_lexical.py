"""Ranked search against scores reckoned for every document."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from boxloom.llm import lexical

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, shard string, term string, posts int, Words int"
ITEMS = "item_id long, text string, item string, rank int, score int"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UP))


def plain(docs, items, top=10):
    """Rows (item_id, rank, doc_id, score) by scoring every document for every item."""
    held = [(d, collections.Counter(t)) for d, t in ((d, terms(x)) for d, x in docs) if t]
    n, words = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, (d, c) in enumerate(held):
            m = 100 - 75 + (75 * sum(c.values()) * n) // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, i))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d, _) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def got(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def texts(seed, n):
    """Words of very unequal frequency; lengths from 1 to some thousands; exact copies."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        size = int(min(3000, 1 + rng.pareto(0.8) * 8))
        out.append(" ".join(f"W{int(x)}" for x in np.minimum(rng.zipf(1.3, size), 4000)))
    return out + out[: n // 3] + [out[5]] * (n // 3)


@pytest.mark.parametrize("window", [1, 16, 512])
def test_against_all_scores(window):
    """One shard after the other, straight from the class, at several widths of window; ties by the hundred."""
    body = texts(1, 1500)
    docs = list(enumerate(body))
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice(body).split()[:40]) + " W1 W1 w2 unknown") for i in range(30)]
    held = [(d, len(terms(t))) for d, t in docs]
    n, words = len(held), sum(x for _, x in held)
    df = collections.Counter(t for _, x in docs for t in set(terms(x)))
    weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for t, k in df.items()}
    asked = {i: list(collections.Counter(terms(t)).items()) for i, t in items}
    old, lexical.FIRST_WINDOW = lexical.FIRST_WINDOW, window
    hits = []
    try:
        for lo in range(0, len(docs), 700):
            shard = lexical._Shard()
            for d, t in docs[lo:lo + 700]:
                shard.add(d, t)
            rows = [r for b in shard.rows("0", pa.int64()) for r in b.to_pylist()]
            rows = [(r["term"], r["posts"], r["heads"], r["data"], r["ids"]) for r in rows]
            hits += lexical._search_shard(rows, asked, weights, n, words, 10)
    finally:
        lexical.FIRST_WINDOW = old
    merged = []
    for i, _ in items:
        mine = sorted((-s, d) for item, d, s in hits if item == i)[:10]
        merged += [(i, r + 1, d, -s) for r, (s, d) in enumerate(mine)]
    assert sorted(merged, key=str) == plain(docs, items)


def test_whole_search(spark):
    body = texts(3, 400)
    docs = list(enumerate(body))
    items = [(i, t[:300]) for i, t in enumerate(body[:12])]
    frame = spark.createDataFrame([(d, t, "s", "t", 1, 1) for d, t in docs], SCHEMA).repartition(6)
    asked = spark.createDataFrame([(i, t, "x", 1, 1) for i, t in items], ITEMS)
    expected = plain(docs, items)
    assert got(lexical.rank_documents(frame, asked)) == expected
    assert got(lexical.search(lexical.build(frame), asked, batch_terms=40)) == expected  # items in several batches


def test_blocks_are_rejected_unpacked(spark):
    """Most blocks of frequent terms stay packed once ten good documents are known."""
    rng = random.Random(4)
    shard = lexical._Shard()
    for d in range(20_000):
        shard.add(d, "rare target pair common" if d % 1500 == 7 else " ".join(["common"] + [f"z{rng.randrange(50)}" for _ in range(6 + d % 40)]))
    rows = {r["term"]: r for b in shard.rows("0", pa.int64()) for r in b.to_pylist()}
    lengths = np.frombuffer(rows[""]["data"], "<u4").astype(np.int64)
    damping = 25 + 75 * lengths * len(lengths) // lengths.sum()
    lists = [(lexical._List(rows[t]["heads"], rows[t]["data"], rows[t]["posts"], w, lengths, damping), 1)
             for t, w in (("rare", 9000), ("target", 9000), ("pair", 9000), ("common", 3), ("z1", 900))]
    docs, scores = lexical._best(lists, len(lengths), np.arange(len(lengths)), 10)
    assert len(docs) == 10 and len({*scores}) == 1
    common = lists[3][0]
    assert len(common.unpacked) < 0.1 * len(common.heads)


def test_odd_rows(spark):
    rows = [(0, None), (1, ""), (2, " .,;\n"), (3, "One two"), (3, "One two"), (None, "one"), (4, "ONE É éa"), (5, "x" * 200_000 + " one"),
            (6, "word " * 5000), (None, None), (7, "a_b-c`d"), (8, "one " * 70_000)]
    items = [(0, "one"), (0, "one"), (None, "É two"), (1, None), (2, ""), (3, "nothing here"), (4, "word one a b c d " * 30)]
    frame = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    asked = spark.createDataFrame([(*r, None, None, None) for r in items], ITEMS)
    assert got(lexical.rank_documents(frame, asked)) == plain(rows, items)
    assert got(lexical.rank_documents(frame.limit(0), asked)) == [] == got(lexical.rank_documents(frame, asked.limit(0)))
    assert got(lexical.rank_documents(frame.where("doc_id < 3"), asked)) == []


def test_string_ids(spark):
    frame = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "y")], "doc_id string, text string")
    asked = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert [(r["rank"], r["doc_id"]) for r in lexical.rank_documents(frame, asked).orderBy("rank").collect()] == [(1, "a"), (2, "b")]
