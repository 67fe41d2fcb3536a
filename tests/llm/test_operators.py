"""Every operator against a plain reckoning in Python, on small tables with nulls, empties, repeats, ties and clashing columns."""

import base64
import bz2
import collections
import gzip
import hashlib
import itertools
import lzma
import math
import re
import urllib.parse
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from boxloom.llm import attention, decontaminate, licenses, mixing, quality, quotes, scoring, secrets, sharding, simhash, substrings

SF = "/root/testdata/sf0.001"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, _w string, row string, Kept int"


def words(text, lower=False):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(UP) if lower else text)


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, a null id, columns with names used inside."""
    base = "Alpha beta gamma delta epsilon zeta eta theta iota kappa. Lambda mu nu xi omicron pi rho sigma tau upsilon."
    texts = [None, "", " \n\t", "one", "one two", base, base, base.upper(), base + "\n" + base, base + " tail", "é " * 3000,
             "# & <b> | *\n# & <b> | *\n\n", "word " * 60, "x y z\x1cq", base.replace("mu", "MU!")]
    rows = [(i, t, None, f"s{i % 3}" if i % 4 else None, None, "w", "r", 1) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, base, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# -- 1


def fingerprint(text):
    w = words(text, lower=True)
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(ids):
    """ids: {id: fingerprint}"""
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(ids), 2):
        if (ids[a] ^ ids[b]).bit_count() <= 4:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("cell", [simhash.CELL, 3])
def test_simhash_components(spark, real, odd, cell):
    near = [(1000 + i, "abc def ghi jkl mno " * 8 + " ".join(f"t{(i * k) % 5}" for k in range(i % 7))) for i in range(60)]
    for docs in (real.select("doc_id", "text"), odd, spark.createDataFrame(near, "doc_id long, text string")):
        rows = pairs(docs)
        ids = {d: fingerprint(t) for d, t in rows if d is not None}
        root = components(ids)
        got = simhash.near_duplicates(docs, cell=cell).collect()
        assert len(got) == len(rows)
        for r in got:
            if r["doc_id"] is not None:
                assert (r["fingerprint"], r["component_id"]) == (f"{ids[r['doc_id']]:016x}", root[r["doc_id"]])
    assert any(r["doc_id"] is None and r["component_id"] == 5 for r in simhash.near_duplicates(odd).collect())


def test_links_of_large_groups_are_a_forest():
    r = np.random.default_rng(1)
    fp = np.uint64(0xF0F0) ^ (np.uint64(1) << r.integers(0, 64, 300).astype(np.uint64))
    fp = np.unique(fp)
    a, b = simhash.linked(fp, np.arange(len(fp)), np.zeros(len(fp), int), np.array(simhash.references(9), np.uint64))
    assert len(a) == len(fp) - 1  # all within 2 bits: one component, no more links than it takes


# -- 2


def base_rules(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def buckets(text, n):
    w = words(text)

    def h(*parts):
        seed = 42
        for p in parts:
            seed = xxhash.xxh64_intdigest(p.encode(), seed)
        return (seed - 2**64 if seed >= 2**63 else seed) % n

    return [h(x) for x in w] + [h(x, y) for x, y in itertools.pairwise(w)]


def test_quality(spark, real, odd):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for docs in (real, odd):
        trusted = {r[0] for r in quality.trusted_ids(labels).collect()}
        rows = pairs(docs)
        raw, target = collections.Counter(), collections.Counter()
        for d, t in rows:
            raw.update(b := buckets(t, quality.BUCKETS))
            target.update(b if d in trusted else [])
        of = quality.log_ratios([(k, raw[k], target[k]) for k in raw], quality.BUCKETS)
        expected = collections.Counter()
        for d, t in rows:
            n, chars, symbols, lines, repeat = base_rules(t)
            failed = n < 50 or 100 * repeat > 50 * n
            b = buckets(t, quality.BUCKETS)
            total = sum(of[k] for k in b)
            kept = not failed and total >= quality.LEAST * len(b)
            expected[d, n, chars, symbols, lines, repeat, failed, kept, total // len(b) if b else None] += 1
        got = quality.assess(docs, labels.transform(quality.trusted_ids))
        assert "ratio" in got.columns and [c for c in docs.columns if c != "Kept"] == got.columns[: len(docs.columns) - ("Kept" in docs.columns)]
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio"]
        assert collections.Counter(tuple(r) for r in got.select(*names).collect()) == expected
        assert got.where("kept").count() == sum(v for k, v in expected.items() if k[7])


# -- 3


def test_quotes(spark):
    rows = [
        (1, 0, "a", "Hello there.\nHow are you?"), (1, 1, "b", "> how  are YOU?\nFine."),
        (1, 2, "a", ">> How are you?\n> Fine.\nGood to hear."), (1, 3, "c", "> nobody wrote this\nMine."), (1, 4, "d", "no quote"),
        (1, 5, "e", "> Good to hear.\n> no quote\n> no quote\nboth"), (2, 0, "a", "> How are you?"), (3, 0, None, None), (None, 0, "x", ">q"),
        (3, None, "y", ""), (4, 0, "a", "same"), (4, 1, "a", "same"), (4, 2, "b", "> same\r\nyes"), (4, 2, "b", "> same\r\nyes"),
    ]
    got = quotes.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert len(got) == len(rows)
    at = {(r["conv_id"], r["turn"]): (r["parent_turn"], r["root_turn"], r["depth"], r["n_quoted"], r["n_linked"], r["text"]) for r in got}
    assert at[1, 0] == (None, 0, 0, 0, 0, "Hello there.\nHow are you?")
    assert at[1, 1] == (0, 0, 1, 1, 1, "Fine.")
    assert at[1, 2] == (1, 0, 2, 2, 1, "Good to hear.")
    assert at[1, 3] == (None, 3, 0, 1, 0, "Mine.")
    assert at[1, 5] == (4, 4, 1, 3, 2, "both")
    assert at[2, 0] == (None, 0, 0, 1, 0, "") and at[3, 0] == (None, 0, 0, 0, 0, None)
    assert at[4, 2] == (1, 1, 1, 1, 2, "yes")  # the latest of equals; lines of the repeated row count together
    order = [(r["conv_id"], r["root_turn"], r["turn"]) for r in got if r["conv_id"] == 1]
    assert order == sorted(order)
    chain = [(9, 0, "a", "line 0")] + [(9, i, "a", f"> line {i - 1}\nline {i}") for i in range(1, 40)]
    deep = quotes.reply_ordered(spark.createDataFrame(chain, "conv_id long, turn int, role string, text string")).collect()
    assert [(r["root_turn"], r["depth"]) for r in deep] == [(0, i) for i in range(40)]

def test_quotes_wrapped_anew_and_nested(spark):
    rows = [
        (1, 0, "a", "The first sentence is about apples.\nThe second is about pears and\nruns over lines."),
        (1, 1, "b", "> The first sentence is\n> about apples. The second is about pears\n> and runs over lines.\nI see."),  # wrapped anew
        (1, 2, "c", ">> The second is about\n>> pears and runs over lines.\nLevel two only."),  # held by 1 at level 1
        (1, 3, "d", "> > The first sentence is about apples.\n> I see.\nBoth levels."),
        (1, 4, "e", "> edited beyond recognition\n>> I see.\nOnly the deeper one matches."),  # 3 quoted "I see." at level 1
        (2, 0, "a", "one\n\ntwo"), (2, 1, "b", "> one\n>\n> two\nthree"),
    ]
    got = quotes.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    at = {(r["conv_id"], r["turn"]): (r["parent_turn"], r["depth"], r["n_linked"]) for r in got}
    assert at[1, 1] == (0, 1, 2) and at[1, 2][0] == 1 and at[1, 3][0] == 1 and at[1, 4][0] == 3
    assert at[2, 1] == (0, 1, 2)


def test_quotes_recall_on_generated_threads(spark):
    """Replies that quote whole, in part, wrapped anew or nested find what they answer in nine cases of ten at least."""
    import random
    import textwrap

    rng = random.Random(8)
    rows, parent = [], {}
    for conv in range(30):
        said = []
        for turn in range(25):
            own = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) + rng.choice(["", "", "", "."]) for _ in range(rng.randint(8, 60))) + "."
            text = textwrap.fill(own, 60)
            if turn and rng.random() < 0.85:
                to = rng.randrange(turn)
                body = said[to]
                how = rng.random()
                if how < 0.4:  # wrapped anew, quotes and all kept apart by level
                    body = "\n".join(line if line.startswith(">") else textwrap.fill(line, 45) for line in (" ".join(
                        x for x in body.split("\n") if not x.startswith(">")), *[x for x in body.split("\n") if x.startswith(">")]))
                elif how < 0.6:
                    lines = body.split("\n")
                    body = "\n".join(lines[: max(1, len(lines) // 2)])
                text = "\n".join(f"> {x}" if not x.startswith(">") else f">{x}" for x in body.split("\n")) + "\n" + text
                parent[conv, turn] = to
            said.append(text)
            rows.append((conv, turn, "user", text))
    got = quotes.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    hit = sum(parent.get((r["conv_id"], r["turn"])) == r["parent_turn"] for r in got if (r["conv_id"], r["turn"]) in parent)
    assert hit >= 0.9 * len(parent) and len(parent) > 500
    assert all(r["parent_turn"] is None for r in got if (r["conv_id"], r["turn"]) not in parent)


def test_quotes_of_one_common_line(spark, none):
    """A line that every message writes and quotes makes as many links as messages, not as many pairs."""
    rows = [(1, t, "user", "> ok\nok") for t in range(3000)]
    linked = quotes.parents(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted((r["turn"], r["parent_turn"]) for r in linked.collect()) == [(t, t - 1) for t in range(1, 3000)]
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string, hash string, kind int")
    assert quotes.reply_ordered(empty).collect() == []


# -- 4


def contamination(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = tokens(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add(str(item))
    out = []
    for d, text in docs:
        w, hit, found = tokens(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if (x := tuple(w[i : i + k])) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[x]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return collections.Counter(out)


def test_decontamination(spark, real, odd, none):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    few = spark.createDataFrame(
        [(1, "Epsilon ZETA eta"), (2, "one"), (3, None), (4, ""), (5, "é"), (6, "Epsilon zeta, eta!"), (10, "gamma delta epsilon zeta eta theta "
         "iota kappa lambda mu nu xi omicron pi rho")], "item_id long, text string")
    for docs, bench in ((real, items), (odd, few), (odd, items)):
        got = decontaminate.hits(docs, bench).collect()
        assert collections.Counter(map(tuple, got)) == contamination(pairs(docs), [(r["item_id"], r["text"]) for r in bench.collect()])
    assert decontaminate.hits(none, items).count() == 0
    assert {r["n_items"] for r in decontaminate.hits(odd, few.limit(0)).collect()} == {0}


def test_decontamination_shuffled_shingles(spark, real, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = sorted(map(tuple, decontaminate.hits(real, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, decontaminate.hits(real, items).collect())) == want


# -- 5


def least_capacity(sizes, shards):
    def enough(c):
        n, at = 1, 0
        for s in sizes:
            if s > c:
                return False
            n, at = (n, at + s) if at + s <= c else (n + 1, s)
        return n <= shards

    return next(c for c in range(max(sizes), sum(sizes) + 1) if enough(c))


@pytest.mark.parametrize("shards,knots", [(24, 8192), (5, 8), (1, 4)])
def test_sharding(real, odd, shards, knots):
    for docs in (real.limit(60), odd):
        rows = pairs(docs)
        groups = collections.Counter()
        for _, t in rows:
            groups[hashlib.md5((t or "").encode()).digest()] += len((t or "").encode()) + 8
        got = sharding.shard(docs, shards, knots).collect()
        loads = collections.Counter()
        for r in got:
            loads[r["shard"]] += r["size"]
        assert max(loads.values()) == least_capacity([groups[k] for k in sorted(groups)], shards)
        assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == collections.Counter(
            (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
        for s in loads:
            assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_sharding_nothing(none):
    assert sharding.shard(none).count() == 0


# -- 6


def test_secrets_unwrap_and_map():
    secret = 'token = "abcdef123456"'
    b64 = lambda b: base64.b64encode(b).decode()
    for wrapped in (urllib.parse.quote(secret), b64(secret.encode()), b64(zlib.compress(secret.encode())),
                    b64(gzip.compress(b64(secret.encode()).encode())), "".join(f"\\u{ord(c):04x}" for c in secret),
                    urllib.parse.quote(b64(("x é " + secret + " yyyy").encode())), urllib.parse.quote(urllib.parse.quote(secret))):
        base, every = secrets.spans_of(f"hé {wrapped} tail")
        assert (base, len(every)) == ([], 1)
        a, b, kind = every[0]
        assert kind == 0 and 3 <= a < b <= 3 + len(wrapped)
        again, inner = secrets.spans_of(f"hé {wrapped} tail"[a:b])
        assert inner or wrapped.startswith(("%", urllib.parse.quote(b64(b"x")[:1])))
    loop = urllib.parse.quote(urllib.parse.quote("%25" * 50))
    assert secrets.spans_of(loop) == ([], [])


def test_secrets_repeated_encodings():
    secret = 'token = "abcdef123456"'
    one, other = base64.b64encode(secret.encode()).decode(), urllib.parse.quote(secret)
    text = f"{one} and {one} and {other} {base64.b64encode(zlib.compress(secret.encode())).decode()} {one}"
    places = [m.span() for m in re.finditer(r"\S{20,}", text)]
    spans = {(a, b) for a, b, _ in secrets.spans_of(text)[1]}
    assert len(places) == 5 and all(any(a <= x < y <= b for x, y in spans) for a, b in places)
    outer = base64.b64encode(f"{one} {one}".encode()).decode()
    assert len(secrets.spans_of(f"{outer} {outer}")[1]) == 4  # two in each copy


def test_secrets_short_and_wrapped_base64():
    for secret in ("token=abcdef", "secret=abcdef", "passwd=abcdefg", "apikey=abcdefgh"):
        text = f"see {base64.b64encode(secret.encode()).decode()} there"
        assert [text[a:b].rstrip("=") for a, b, _ in secrets.spans_of(text)[1]] == [text.split()[1].rstrip("=")]
    noise = "".join(chr(97 + i * i % 26) + " é"[i % 2] for i in range(60))
    plain = f'{noise} token = "abcdef123456" {noise}'.encode()
    random = np.random.default_rng(0).integers(33, 127, 300).astype(np.uint8).tobytes()
    for raw in (plain, zlib.compress(random + b" " + plain)):
        for width, end, shape in itertools.product((64, 76), ("\n", "\r\n"), ("{}", "Begin\n{}\nEnd of it", "key: {}\n\nmore")):
            encoded = base64.b64encode(raw).decode()
            wrapped = end.join(encoded[i : i + width] for i in range(0, len(encoded), width))
            assert secrets.spans_of(shape.format(wrapped))[1], (width, end, shape)


def test_secrets_in_every_member_of_a_stream():
    secret = b'token = "abcdef123456" '
    for pack in (gzip.compress, bz2.compress, lzma.compress):
        for raw in (pack(b"nothing here ") + pack(secret), pack(b"") + pack(b"nothing here ") + pack(secret) + b"tail"):
            assert secrets.spans_of(base64.b64encode(raw).decode())[1]
    assert secrets.unpacked(gzip.compress(secret) * 2, 2 * len(secret)) == secret * 2
    assert secrets.unpacked(gzip.compress(secret) * 2, 2 * len(secret) - 1) == secret
    assert secrets.unpacked(gzip.compress(secret) * 2, len(secret) - 1) is None

def test_secrets_glued_and_packed_encodings():
    """Encodings with something in front or behind, bytes packed under percent signs and escapes, streams cut off."""
    secret = 'token = "abcdef123456"'
    b64 = lambda x: base64.b64encode(x).decode()
    percent = lambda x: "".join(f"%{c:02X}" for c in x)
    for front in ("x/", "key-", "a/b/c/", "word", "_", "abcde+", "Zm9v"):
        for body in (secret.encode(), gzip.compress(secret.encode()), zlib.compress(secret.encode()), ("x é " + secret).encode()):
            for behind in ("", "/tail", "-x"):
                whole = f"see {front}{b64(body).rstrip('=')}{behind} there"
                assert any(k == 0 for *_, k in secrets.spans_of(whole)[1]), (front, body[:4], behind)
    for wrapped in (percent(zlib.compress(secret.encode())), "".join(f"\\x{c:02x}" for c in gzip.compress(secret.encode())),
                    "".join(f"\\u{{{ord(c):x}}}" for c in secret), "".join(f"\\{ord(c):03o}" for c in secret),
                    "".join(f"\\x{c:02x}" for c in ("ü " + secret).encode()), b64(gzip.compress(secret.encode())[:-9]),
                    percent(b64(bz2.compress(secret.encode())).encode()), b64(percent(lzma.compress(secret.encode())).encode())):
        base, every = secrets.spans_of(f"hé {wrapped} tail")
        assert every and not [x for x in base if x[2] == 0], wrapped[:40]
        assert all(3 <= a < b <= 3 + len(wrapped) for a, b, _ in every)


def test_secrets_nested_percent_in_linear_time():
    import time

    text = "token" + "%" + "25" * 20_000 + "3Dabcdef"
    start = time.perf_counter()
    assert (0, len(text), 0) in secrets.spans_of(text)[1]
    assert time.perf_counter() - start < 2


def test_secrets_recall_on_planted_encodings(spark, real):
    """Nine in ten of the encoded secrets planted in the given documents are found, at their place."""
    import random

    rng = random.Random(5)
    encode = [lambda s: base64.b64encode(s).decode(), lambda s: "cfg/" + base64.b64encode(s).decode(), lambda s: base64.b64encode(gzip.compress(s)).decode(),
              lambda s: "".join(f"%{c:02x}" for c in s), lambda s: "".join(f"\\u{c:04x}" for c in s), lambda s: "".join(f"&#{c};" for c in s),
              lambda s: base64.b64encode("".join(f"%{c:02x}" for c in zlib.compress(s)).encode()).decode()]
    rows, where = [], {}
    for i, r in enumerate(real.where("length(text) < 3000").limit(140).collect()):
        kind = ["token=", "password: ", "api_key = ", "secret="][i % 4]
        coded = encode[i % len(encode)]((kind + "".join(rng.choice("abcdefXYZ0189") for _ in range(rng.randint(6, 30)))).encode())
        text = r["text"] or ""
        cut = len(text) // 2
        rows.append((i, f"{text[:cut]} {coded} {text[cut:]}"))
        where[i] = (cut + 1, cut + 1 + len(coded))
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hit = sum(any(k == "assign" and where[r["doc_id"]][0] <= int(a) < int(b) <= where[r["doc_id"]][1] for k, a, b in (
        s.split(":") for s in r["spans"].split(",") if s)) for r in found)
    assert hit >= 0.9 * len(rows) and len(rows) > 100


def test_secrets_of_an_empty_table(none):
    assert secrets.find_secrets(none).collect() == []


def test_secrets_base(spark, real, odd):
    fixed = spark.createDataFrame([(1, "secret:token:abcdefgh PASSWORD='hunter22' api_key=x"), (2, "AKIA" + "A" * 16 + " AKIA" + "B" * 15),
                                   (3, "0" * 24 + "g" + "f" * 23), (4, "Kelvin tokKen=abcdef")], "doc_id long, text string")
    assign = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for docs in (real, odd, fixed):
        want = collections.Counter()
        for d, t in pairs(docs):
            t = t or ""
            found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[1]) >= 6]
            found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
            found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
            text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
            want[d, *(sum(k == n for _, k, _ in found) for n in range(3)), hashlib.sha256(text.encode()).hexdigest()] += 1
        got = secrets.find_secrets(docs)
        assert collections.Counter(tuple(r)[:5] for r in got.collect()) == want


# -- 7


def test_licenses(spark, odd):
    mit, apache = licenses.TEMPLATES["MIT"][2], licenses.TEMPLATES["Apache-2.0"][1]
    w = apache.split()
    rows = [(1, "x " * 300 + mit + " y" * 50), (2, " ".join(w[:30] + ["inserted"] + w[30:])), (3, " ".join(w[: len(w) // 2])),
            (4, "Released under the MIT License. Released under the MIT License."), (5, "released under a license"), (6, None)]
    got = licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append((r["license"], r["template"], dict(rows)[r["doc_id"]][r["start"] : r["end"]], r["containment"]))
    assert any(x[:2] == ("MIT", 2) and x[2] == mit and x[3] == 1.0 for x in by[1])
    assert any(x[:2] == ("Apache-2.0", 1) and 0.8 <= x[3] < 1 for x in by[2])
    assert all(x[:2] != ("Apache-2.0", 1) for x in by[3]) and not by[5] and not by[6]
    assert [x for x in by[4] if x[:2] == ("MIT", 0)] and licenses.find_licenses(odd).count() == 0
    with pytest.raises(ValueError):
        licenses.find_licenses(odd, {"short": ["four words only here"]})


def test_bands_miss_little():
    for size in (1, 3, 8, 60, 150):
        stride, width, bands = licenses.window_of(size)
        held = math.ceil(0.8 * size)
        s = held / (width * stride + size - held)
        assert (1 - s) ** bands <= licenses.MISSED and width * stride >= size + stride - 1


# -- 8


def test_mixing(real, odd, none):
    for docs in (real, odd):
        got = mixing.mix(docs).collect()
        rows = [(r["doc_id"], r["source"], len(words(r["text"]))) for r in docs.collect()]
        sizes = collections.Counter()
        for _, s, n in rows:
            sizes[s] += n
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: i % 3 + 1 for i, s in enumerate(names)}
        target, free, rest = {}, set(names), float(sum(sizes.values()))
        while over := [s for s in free if 3 * sizes[s] <= rest * weight[s] / sum(weight[x] for x in free)]:
            for s in over:
                target[s] = 3.0 * sizes[s]
            free -= set(over)
            rest -= sum(target[s] for s in over)
        target |= {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        taken = collections.Counter()
        for r in got:
            taken[r["source"]] += r["taken"]
            assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], target[r["source"]], abs_tol=1e-6)
            assert 0 <= r["taken"] <= 3 * r["size"] and len(r["positions"]) <= 3
            assert r["positions"] == sorted(r["positions"]) and all(0 <= t <= 1 for t in r["positions"])
        assert collections.Counter((r["doc_id"], r["source"], r["size"]) for r in got) == collections.Counter(rows)
        assert all(abs(taken[s] - target[s]) < 1.000001 for s in names)
        firsts = [r["position"] for r in got if r["position"] is not None]
        assert firsts == sorted(firsts) and mixing.mix(docs).collect() == got
    assert mixing.mix(none).count() == 0


def test_demand_is_inverted(spark):
    for slope in (-0.5, 0.0, 0.5):
        for share in (0.0, 0.1, 0.5, 1.0):
            t = spark.range(1).select(mixing.demand_time(F.lit(share), F.lit(slope))).first()[0]
            assert math.isclose(t + slope * (t * t - t), share, abs_tol=1e-12)


# -- 9


def plain_repeats(rows, least=substrings.MIN_WORDS):
    seen, gone = {}, []
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    found = [(d is None, d, row, *u) for row, d, t in order for u in substrings.units_of(t or "", least)]
    for none, d, row, start, end, line, n, digest in sorted(set(found), key=lambda x: (x[0], x[1] or 0, x[2], x[3])):
        if (first := seen.setdefault(digest, (d, row, start))) != (d, row, start):
            gone.append((row, line, start, end, n, d, first[0], first[2]))
    whole = {(g[0], g[1]): (g[2], g[3]) for g in sorted(gone, key=lambda g: g[3] - g[2])}
    keep = [g for g in gone if (g[2], g[3]) == whole[g[0], g[1]] or not (whole[g[0], g[1]][0] <= g[2] and g[3] <= whole[g[0], g[1]][1])]
    return {(row, d, a, b, n, f, fs) for row, _, a, b, n, d, f, fs in keep}


def test_substrings(real, odd, none):
    for docs in (real, odd):
        rows = docs.drop("row").select("doc_id", "text").coalesce(1).withColumn("row", F.monotonically_increasing_id())
        want = plain_repeats([(r["row"], r["doc_id"], r["text"]) for r in rows.collect()])
        assert {tuple(r) for r in substrings.repeats(rows).collect()} == want and want
        cleaned = substrings.without_repeats(docs)
        assert cleaned.count() == docs.count()
    assert substrings.without_repeats(none).count() == 0


def test_substrings_cut_text(spark):
    passage = "Here is a passage of many words that stands alone. It goes on for another long sentence of many words."
    rows = [(1, f"First words of one that are its own. {passage}\nEnd of it."), (2, f"Other opening words that nobody else has at all. {passage} And a tail of words that is new.")]
    got = {r["doc_id"]: r for r in substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["text"] == rows[0][1] and not got[1]["removed"]
    assert "passage" not in got[2]["text"] and got[2]["text"].startswith("Other opening") and got[2]["text"].endswith("is new.")
    assert [rows[1][1][s["start"] : s["end"]] for s in got[2]["removed"]] == [x + "." for x in passage[:-1].split(". ")]


def test_substrings_of_short_lines(spark):
    menu = "\n".join(f"Item {i} here" for i in range(20))  # a passage of 60 words in lines of 3
    rows = [(1, f"Own start\n{menu}\nAll rights reserved."), (2, f"Other start\n{menu}\nall  Rights reserved.\n漢字の長い行"), (3, "漢字の長い行\nnew")]
    got = {r["doc_id"]: r["text"] for r in substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[2].split() == ["Other", "start", "漢字の長い行"] and got[3].split() == ["new"]


# -- 10


def test_scoring(spark, real, odd, none):
    for docs in (real, odd):
        got = collections.Counter()
        for r in scoring.score(docs, share=2).collect():
            got[r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)] += 1
            assert math.isfinite(r["score"])
        held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
        rows = [(d, words(t, lower=True) + [None]) for d, t in pairs(docs)]
        c = collections.Counter(w for d, t in rows if not held(d) for w in t)
        n, v = sum(c.values()), len(c)
        want = collections.Counter(
            (d, held(d), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for d, t in rows)
        assert got == want
    assert scoring.score(none).count() == 0


def test_model_beats_the_unigram_on_held_out_text(spark):
    kinds = "sun moon tree river stone cloud bird fish house road bread milk salt iron gold wood glass paper book lamp".split()
    rows = [(i, " ".join(kinds[(i + 7 * k) % 20] for k in range(200))) for i in range(120)]
    got = scoring.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(1), share=1, rounds=2).where("held_out").collect()
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_every_training_row_teaches(spark, real):
    rows = real.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shares = [scoring.taught(rows, r, scoring.SHARE) for r in range(scoring.ROUNDS)]
    assert collections.Counter(tuple(x) for s in shares for x in s.collect()) == collections.Counter(pairs(rows))
    for d in (2, 3, 4):  # a single row must teach, whatever its hash
        one = spark.createDataFrame([(d, f"row {d} of a small corpus " * 20)], "doc_id long, text string")
        assert not one.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).count()
        assert scoring.score(one).first()["score"] != scoring.score(one, rounds=0).first()["score"]
    with pytest.raises(ValueError):
        scoring.score(rows, rounds=2, share=16)


def test_attention_is_causal_and_its_gradients_hold():
    r = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in attention.fresh(7, np.zeros(7)).items()}
    p["out"] = r.standard_normal((16, 7)) * 0.3
    lengths, codes = np.array([5, 0, 40, 20]), r.integers(0, 50000, 65) * 65536 + r.integers(0, 50000, 65)
    laid = attention.laid_out(codes, lengths, r.integers(0, 6, 65536), 6)
    _, g = attention.gradients(p, *laid[:5])
    for k in p:
        i = (int(laid[0][2, 5]), 3) if k == "e" else tuple(r.integers(0, s) for s in p[k].shape)
        low, high = ({**p, k: p[k].copy()} for _ in range(2))
        low[k][i] -= 1e-4
        high[k][i] += 1e-4
        slope = (attention.gradients(high, *laid[:5])[0] - attention.gradients(low, *laid[:5])[0]) / 2e-4
        assert math.isclose(slope, g[k][i], rel_tol=1e-3, abs_tol=1e-7)
    scores, _ = attention.position_scores(p, laid)
    changed = codes.copy()
    changed[30] += 65536
    other, _ = attention.position_scores(p, attention.laid_out(changed, lengths, np.zeros(65536, int) + laid[3].max(), 6))
    assert len(scores) == 69 and np.isfinite(other).all()
    same = attention.laid_out(changed, lengths, r.integers(0, 6, 65536), 6)
    a, _, _ = attention.forward(p, laid[0], laid[1], laid[2])
    b, _, _ = attention.forward(p, same[0], same[1], same[2])
    where = np.flatnonzero(np.abs(a - b).max(axis=-1).ravel()[laid[5]] > 0)
    assert where.min() > 30 + 2  # two texts, and so two ends, come before word 30


def test_words_are_encoded_once_in_a_worker(monkeypatch):
    import pyarrow as pa

    odd = "A\x1cb\u00a0c\u2003d\x85e  f\tg\nh\x0bi\x0cj\rk "
    (_, found, lengths), = scoring.texts(pa.RecordBatch.from_arrays([pa.array([odd, "", "x"])], ["text"]), 0)
    assert [w.decode() for w in found] == words(odd) + ["x"] and list(lengths) == [len(words(odd)), 0, 1]
    coder = scoring.subwords(scoring.TOKENIZER)
    assert coder is scoring.subwords(scoring.TOKENIZER)
    monkeypatch.setattr(scoring, "REMEMBERED", 0)  # what is not remembered is encoded all the same
    fresh = scoring.Subwords(scoring.TOKENIZER)
    for w in found:
        ids = coder.coder.encode_ordinary(" " + w.decode())
        assert coder[w] == fresh[w] == ids[0] * 65536 + ids[-1] and not fresh


def test_texts_are_encoded_once_for_all_passes(spark):
    """Training and scoring read ids: a text itself is read for the counts and to be encoded, whatever the number of rounds."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    rows = [(i, " ".join(f"W{(i * k) % 17}\x0b" for k in range(i))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert scoring.score(frame.withColumn("text", counted("text")), rounds=3, share=3).count() == 60
    assert 60 <= read.value <= 120


def test_words_of_a_slice_are_encoded_together(monkeypatch):
    found = [w.encode() for w in ["sun", "\x85", "l\u2028m", "漢字", "sun", "a" * 3000, "\x00", "ééux."]]
    for kept in (3, 400_000):
        monkeypatch.setattr(scoring, "REMEMBERED", kept)
        coder = scoring.Subwords(scoring.TOKENIZER)
        want = [ids[0] * 65536 + ids[-1] for w in found for ids in [coder.coder.encode_ordinary(" " + w.decode())]]
        for part in (found[:3], found, found, []):
            assert list(coder.codes(part)) == want[: len(part)]
        assert len(coder) == min(kept, 7) and all(coder[w] == c for w, c in zip(found, want, strict=True))


def test_encoded_rows(spark, odd):
    docs = odd.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(False).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    texts, known = [r["text"] for r in docs.collect()], {}
    low = docs.withColumn("text", F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    hashes = collections.Counter(r["h"] for r in low.select(scoring.row_hash().alias("h")).collect())
    worded = [words(t, lower=True) for t in texts]
    for w in itertools.islice(itertools.chain.from_iterable(worded), 0, None, 2):
        known[w.encode()] = len(known) + 1
    got = scoring.encoded(docs, scoring.TOKENIZER, known, 1000.0, 9).orderBy("_row").collect()
    assert len(got) == len(texts) and scoring.word_counts(docs.limit(0)).count() == 0
    assert collections.Counter(r["hash"] for r in got) == hashes
    coder = scoring.subwords(scoring.TOKENIZER)
    by_text = collections.Counter()
    for w in worded:
        sure = sum(math.log10((known[x.encode()] + 1) / 1000) for x in w if x.encode() in known) + math.log10(10 / 1000)
        by_text[len(w) + 1, sum(x.encode() in known for x in w) + 1, round(sure, 6), tuple(x for x in w if x.encode() not in known),
                tuple(coder[x.encode()] for x in w)] += 1
    assert by_text == collections.Counter(
        (r["n_tokens"], r["known"], round(r["sure"], 6), tuple(r["rare"]), tuple(c % 2**32 for c in r["codes"])) for r in got)
    want = collections.Counter(itertools.chain.from_iterable(worded))
    assert {r["word"]: r["n"] for r in scoring.word_counts(docs).collect()} == want


def test_shares_hold_for_extreme_numbers():
    x = np.array([[3.0, 1.0, -2.0], [500.0, 499.0, -400.0], [-500.0, -501.0, -900.0]], np.float32)
    want = x - x.max(axis=1, keepdims=True)
    want = want - np.log(np.exp(want).sum(axis=1, keepdims=True))
    for rows in ([0], [0, 1], [0, 2], [0, 1, 2]):
        assert np.allclose(attention._softmax(x[rows]), np.exp(want[rows]), atol=1e-6)
        for k in range(3):
            assert np.allclose(attention.log_share(x[rows], np.full(len(rows), k)), want[rows, k], rtol=1e-5)


def test_columns_with_working_names(spark):
    """Columns named like those used inside ride along unharmed."""
    base = " ".join(f"w{k}" for k in range(30))
    names = ["doc_id", "text", "_w", "_to", "_met", "_true", "_n_words", "_N_HIT", "_wins", "_row", "_clean"]
    docs = spark.createDataFrame([(1, base, *range(9)), (2, "clean words only", *range(9)), (3, base, *range(9))], names)
    items = spark.createDataFrame([(7, base)], "item_id long, text string")
    kept = decontaminate.uncontaminated(docs, items)
    assert kept.columns == names and [tuple(r) for r in kept.collect()] == [(2, "clean words only", *range(9))]
    cleared = substrings.without_repeats(docs)
    assert {r["doc_id"]: (r["text"], r["_row"]) for r in cleared.collect()} == {1: (base, 7), 2: ("clean words only", 7), 3: ("", 7)}
    assert decontaminate.uncontaminated(docs.limit(0), items).collect() == [] == substrings.without_repeats(docs.limit(0)).collect()
