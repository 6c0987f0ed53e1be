"""Secret scans, the prefix trie and importance resampling against brute force, and on the rows that are hard."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from duskfield.llm import importance, prefix_trie, secret_scan

DOC = "doc_id long, text string, source string, score double, rank string"


# --- secrets -------------------------------------------------------------------------------------------------------


def brute_spans(text):
    kinds = [(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6, re.ASCII | re.IGNORECASE), (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20, 0), (r"[0-9a-f]+", lambda m: len(m[0]) >= 24, 0)]
    out = [(k, *m.span()) for k, (p, ok, flags) in enumerate(kinds) for m in re.finditer(p, text, flags) if ok(m)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_base_patterns_of_secrets():
    cases = ['TOKEN = "abcdef"', "token=abc", "secret: token = abcdefgh", "api_key:'x.y=z-1'; ApiKey=abcdef", "AKIA" + "A" * 16, "AKIA" + "A" * 15, "AKIAAKIA" + "B" * 15, "xAKIA" + "Q9" * 20 + "a", "f" * 24, "g" + "0a" * 12 + "G", "0" * 23, "paſſword=abcdefg toKen=abcdefg", "token" + " " * 500 + "=" + " " * 500 + "abcdefgh", "token=token=abcdef", "", "日本token=日本abcdef"]
    random.seed(3)
    parts = ["token", "secret", "passwd", "=", ":", " ", '"', "'", "AKIA", "ABCDEF0123456789", "deadbeef01234567", "abc", ".", "é", "\n", "api_key"]
    cases += ["".join(random.choices(parts, k=random.randint(1, 40))) for _ in range(3000)]
    for text in cases:
        assert secret_scan.base_spans(text) == brute_spans(text), text


@pytest.fixture(scope="module")
def planted():
    """Texts with random strings of four alphabets among words, numbers, paths and names, and what stands where."""
    random.seed(5)
    syllables = ["th", "an", "ing", "er", "on", "le", "ou", "re", "st", "en", "ti", "ble"]
    word = lambda: "".join(random.choices(syllables, k=random.randint(1, 4)))
    ordinary = [lambda: "-".join(word() for _ in range(5)), lambda: "/".join(word() for _ in range(6)), lambda: "_".join(word() for _ in range(5)), lambda: "".join(random.choices("0123456789", k=16)), lambda: "".join(word() for _ in range(9)), lambda: word() * 6]
    alphabets = list(secret_scan.ALPHABETS.values())[1:]
    rows, want = [], {}
    for k in range(400):
        words, spans = [], []
        for _ in range(random.randint(5, 60)):
            at = len(" ".join(words)) + bool(words)
            p = random.random()
            if p < 0.02:
                value = "".join(random.choices(random.choice(alphabets), k=random.randint(28, 48)))
                spans.append((at, at + len(value)))
            else:
                value = random.choice(ordinary)() if p < 0.12 else f"{word()}é" if p < 0.15 else word()
            words.append(value)
        rows.append((k, " ".join(words), "s", 1.0, "r"))
        want[k] = spans
    return rows, want


def test_random_strings_are_found_and_ordinary_ones_left(spark, planted):
    rows, want = planted
    got = {r["id"]: [(s["start"], s["end"]) for s in r["more"]] for r in secret_scan.find_secrets(spark.createDataFrame(rows, DOC).repartition(5)).collect()}
    found = {(d, s) for d, spans in got.items() for s in spans}
    true = {(d, s) for d, spans in want.items() for s in spans}
    assert len(true) > 150 and len(found & true) >= 0.97 * len(true) and len(found & true) >= 0.97 * len(found)


def test_evidence_is_brute_force(spark, planted):
    """The same candidates and the same ratios from dictionaries over characters."""
    rows, _ = planted
    drawn, numbers, ordinary = Counter(), Counter(), Counter()
    state = lambda c: c if c in secret_scan.ALPHABET else " "
    for counts, alphabets in ((drawn, secret_scan.ALPHABETS.values()), (numbers, ["0123456789"])):
        for s in secret_scan.drawn_strings(list(alphabets)):
            counts.update(zip(f" {s}", f"{s} ", strict=True))
    for _, text, *_ in rows:  # there are no base spans among these texts
        rest = re.sub("(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}", " ", text)
        t = "".join(state(c) * len(c.encode()) for c in f" {rest} ")
        ordinary.update(zip(t[:-1], t[1:], strict=True))
    states = " " + secret_scan.ALPHABET
    size = sum(ordinary.values())
    p = {}
    for a in states:
        r = {b: drawn[a, b] + 1 for b in states}
        o = {b: ordinary[a, b] * secret_scan.ORDINARY / size + numbers[a, b] + 1 for b in states}
        p |= {(a, b): math.log(r[b] / sum(r.values())) - math.log(o[b] / sum(o.values())) for b in states}
    want = set()
    for d, text, *_ in rows:
        for m in re.finditer(r"[A-Za-z0-9+/_-]+", text):
            if len(m[0]) >= 16 and sum(p[x] for x in zip(f" {m[0]}", m[0], strict=False)) >= secret_scan.MARGIN:
                want.add((d, *m.span()))
    got = {(r["id"], s["start"], s["end"]) for r in secret_scan.find_secrets(spark.createDataFrame(rows, DOC)).collect() for s in r["more"]}
    assert got == want


def test_secrets_of_hard_rows(spark):
    secret = "0123456789abcdef" * 2
    rows = [(1, None, None, None, None), (1, "", "s", 0.0, ""), (None, f"token={secret}", None, None, None), (2, f"é {secret}", None, None, None), (2, f"é {secret}", None, None, None), (3, "token " * 200_000, None, None, None)]
    got = secret_scan.find_secrets(spark.createDataFrame(rows, DOC)).collect()
    plain = sorted(((r["id"] or 0, [tuple(s) for s in r["base"]], len(r["more"])) for r in got), key=str)
    assert plain == sorted([(1, [], 0), (1, [], 0), (0, [(0, 0, 38), (2, 6, 38)], 0), (2, [(2, 2, 34)], 0), (2, [(2, 2, 34)], 0), (3, [], 0)], key=str)
    assert secret_scan.find_secrets(spark.createDataFrame([], DOC)).collect() == []
    both = spark.createDataFrame([([(2, 5, 9), (0, 5, 9), (3, 1, 4)],)], "s array<struct<kind:int,start:long,end:long>>")
    assert both.select(secret_scan.listed(both["s"])).first()[0] == "random:1:4,assign:5:9,hex:5:9"


# --- prefix trie ---------------------------------------------------------------------------------------------------


def brute_trie(convs):
    """Nodes by dictionaries of beginnings; a turn is any hashable that ends in its length."""
    members, kids, below = defaultdict(list), defaultdict(list), {}
    for c, t in convs:
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append((c, len(t)))
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        own = (len(members[k]) - 1) * (k[-1][-1] if k else 0)
        below[k] = (sum(below[q][0] for q in kids[k]) or 1, own + sum(below[q][1] for q in kids[k]))
    least = {k: min(c for c, _ in m) for k, m in members.items()}
    digest = lambda k: hashlib.sha256(",".join(str(c) for c, n in sorted(members[k]) if n == len(k)).encode()).hexdigest()
    return sorted(((least[k], len(k), least[k[:-1]] if k else None, len(m), len(kids[k]), *below[k], digest(k)) for k, m in members.items()), key=str)


def tried(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed,n,blocks,letters,most", [(1, 40, 1, 2, 6), (2, 60, 7, 2, 9), (3, 50, 20, 1, 5), (4, 30, 30, 4, 12), (5, 1, 3, 1, 4), (6, 45, 6, 3, 3)])
def test_trie(spark, seed, n, blocks, letters, most):
    random.seed(seed)
    turns = [(hashlib.sha256(bytes([k])).hexdigest()[:32], random.randint(0, 9)) for k in range(letters)]
    convs = [(random.randint(-50, 900) * 1000 + k, random.choices(turns, k=random.randint(0, most))) for k in range(n)]
    convs += [(10**7 + k, convs[0][1]) for k in range(n // 2)]  # copies over several blocks
    rows = [(c, [(k, a, b) for k, (a, b) in enumerate(t)], "x") for c, t in convs]
    df = spark.createDataFrame(rows, "conv_id long, turns array<struct<turn:long,digest:string,chars:int>>, depth string").repartition(3)
    assert tried(prefix_trie.prefix_trie(df, blocks)) == brute_trie(convs)


def test_blocks_know_their_neighbours():
    """Smaller minima, sums and children between blocks against loops."""
    rng = np.random.default_rng(4)
    for size in (1, 2, 5, 33):
        rows = [{k: int(v) for k, v in zip(("depth", "kids", "n", "s", "leaves", "low"), r, strict=True)} for r in rng.integers(0, 6, (size, 6))]
        b = prefix_trie.Blocks(rows)
        at, depth = (a.ravel() for a in np.meshgrid(np.arange(size), np.arange(8)))
        end, low = b.end(at, depth)
        begin, kids, sums = b.begin(at, depth), b.children(at, end, depth), b.between("s", at, end)
        for k, (i, d) in enumerate(zip(at, depth, strict=True)):
            e = next((j for j in range(i + 1, size) if rows[j]["depth"] < d), size)
            assert end[k] == e and begin[k] == next((j for j in range(i - 1, -1, -1) if rows[j]["depth"] < d), -1)
            inner = rows[i + 1 : e]
            assert low[k] == min((r["low"] for r in inner), default=2**63 - 1) and sums[k] == sum(r["s"] for r in inner)
            assert kids[k] == sum(r["kids"] for r in inner if r["depth"] == d)


def test_trie_from_turns(spark):
    """Nulls, ties, repeats, missing heads, a turnless conversation and long ones, from rows to nodes."""
    rows = [(100, None, "user", "first"), (100, 1, None, "b"), (100, 2, "user", None), (100, 2, "user", None), (None, 0, "user", "lost"), (299, 0, "a", "long " * 100_000), (307, 0, "a", "x"), (-7, 5, "r", "é🙂")]
    rows += [(c, t, "user", f"{t}") for c in range(101, 140) for t in range(c % 5)] + [(150, t, "user", "same") for t in range(700)]
    df = spark.createDataFrame([(*r, "s", 0) for r in rows], "conv_id long, turn long, role string, text string, source string, depth int")
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    digest = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()[:32]
    own = {c: [(r, t, len(t)) for *_, r, t in sorted(v, key=lambda x: (x[0], x[1], digest(x[2], x[3])))] for c, v in own.items()}
    built = []
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, int(math.copysign(abs(c) - abs(c) % 100, c))
        built.append((c, own.get(base, [])[:h] + turns[h:]))
    assert any(not t for _, t in built) and len({tuple(t[:1]) for _, t in built}) >= 3
    assert tried(prefix_trie.prefix_trie(prefix_trie.with_heads(prefix_trie.sequences(df)), 5)) == brute_trie(built)
    assert prefix_trie.prefix_trie(prefix_trie.with_heads(prefix_trie.sequences(df.limit(0)))).collect() == []


# --- importance ----------------------------------------------------------------------------------------------------


def brute_resample(docs, target, low, high, buckets, percent, least):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(low, high + 1) for i in range(len(w) - n + 1)]

    have = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for *_, f in have for b in f), Counter(b for x in target for b in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for d, n, f in have:
        w = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[3], r[2]))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("low,high,percent", [(1, 1, 10), (1, 3, 35), (2, 2, 100)])
def test_resample(spark, low, high, percent):
    random.seed(8)
    vocab = [f"w{k}" for k in range(60)] + ["É", "naïve", "日本", "AbC", "o'clock", "x_y"]
    docs = [(k, " ".join(random.choices(vocab[: random.choice([5, 66])], k=random.choice([0, 3, 25, 60])))) for k in range(150)]
    docs += [(7, None), (8, ""), (9, " \t.,"), (None, "one two " * 20), (3, docs[5][1]), (3, docs[5][1]), (500, "long word " * 60_000), (501, "a\x00b " * 20)]
    target = [" ".join(random.choices(vocab[3:12], k=30)) for _ in range(20)] + [None, ""]
    x = spark.createDataFrame([(d, t, "s", 1.0, "r") for d, t in docs], DOC).repartition(4)
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(x, goal, low, high, 500, percent, 20)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(docs, target, low, high, 500, percent, 20)


def test_resample_of_nothing(spark):
    x, goal = spark.createDataFrame([], DOC), spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(x, goal).collect() == []
    one = spark.createDataFrame([(1, "word " * 30, "s", 1.0, "r")], DOC)
    assert [tuple(r) for r in importance.resample(one, goal, percent=100).collect()] == brute_resample([(1, "word " * 30)], [], 1, 1, 10_000, 100, 20)
