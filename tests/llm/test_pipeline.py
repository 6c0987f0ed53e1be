"""The pipeline's stages on the smallest tables: what each keeps follows from its own input."""

import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from duskfield.llm import minhash, mixing, quality_rules

DATA = "/root/testdata/sf0.001"


def test_stages_take_odd_rows(spark):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(1, words, "en", "s", 5), (2, words, "en", "s", 5), (3, None, None, None, None), (4, "", "en", "s", 0), (None, words + " x", "en", "s", 3), (1, words, "en", "s", 5), (6, " ".join(f"v{i}" for i in range(40)), "en", "t", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        if name != "packing":
            assert out.columns == docs.columns
        if name == "quality rules":
            assert sorted(r["doc_id"] or -1 for r in out.collect()) == [-1, 1, 1, 2, 6]
        if name == "near dedup":
            assert Counter(r["doc_id"] for r in out.where("doc_id <> 3 and doc_id <> 4").collect()) == Counter([1, 6])
        assert stage(spark, docs.where("false"), DATA).count() == 0


def _similarity(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_near_dedup_takes_similarity_of_four_fifths(spark):
    words = lambda c: [f"{c}{i}" for i in range(104)]
    texts = []
    for c, cut in (("a", 80 + 4), ("b", 79 + 4), ("c", 83 + 4)):  # the copy is the first words only
        texts += [" ".join(words(c)), " ".join(words(c)[:cut])]
    assert [_similarity(texts[k], texts[k + 1]) for k in (0, 2, 4)] == [0.8, 0.79, 0.83]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, DATA).collect()) == [0, 2, 3, 4]


@pytest.mark.parametrize("small", [3, 64])
def test_links_of_four_fifths_hold(spark, monkeypatch, small):
    """A group of copies at all distances has brute force's classes at the stage's threshold, by hubs and by pairs."""
    monkeypatch.setattr(minhash, "SMALL_BUCKET", small)
    random.seed(4)
    texts = []
    for i in range(90):
        x = [f"b{i}" for i in range(150)]
        for _ in range(random.choice([0, 1, 2, 3, 4, 5, 6, 8, 10])):
            x[random.randrange(len(x))] = random.choice(["p", "q", f"r{i}"])
        texts.append(" ".join(x))
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if _similarity(texts[a], texts[b]) >= 0.8 and root[a] != root[b]:
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), percent=80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(root))
    assert (minhash.bands_for(85), minhash.bands_for(80)) == (25, 37)
    assert all((1 - (p / 100) ** minhash.ROWS) ** minhash.bands_for(p) <= minhash.MISS for p in (80, 85))


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_quality(rows):
    counted, hosts = [], defaultdict(list)
    for r in rows:
        t = r["text"] or ""
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        at = defaultdict(list)
        for k in range(len(w) - 4):
            at[tuple(w[k : k + 5])].append(k)
        repeated = len({k + j for v in at.values() if len(v) > 1 for k in v for j in range(5)})
        chars, signs = sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t))
        fails = (len(w) < 10, 100 * repeated > 20 * len(w), 10 * signs > len(w), chars < 2 * len(w) or chars > 15 * len(w), len(lines) - len(set(lines)) >= 5)
        counted.append((r, fails))
        hosts[r["source"]].append(fails)
    bad, n = set(), len(rows)
    for k in range(5):
        x = {h: (sum(f[k] for f in v), len(v)) for h, v in hosts.items()}
        m = sum(a for a, _ in x.values()) / n
        spread = max(sum(a * a / b for a, b in x.values()) / n - m * m, 0) - m * (1 - m) * len(x) / n
        s = min(max(m * (1 - m) / spread - 1, 1), 1000) if spread > 1e-12 else 1000
        limit = min(0.5, m + 2 * math.sqrt(m * (1 - m) / (s + 1)))
        for h, (a, b) in x.items():
            p = (a + m * s) / (b + s)
            if p - 2 * math.sqrt(p * (1 - p) / (b + s + 1)) > limit:
                bad.add(h)
    return [r for r, f in counted if not (f[0] or f[1]) and not (any(f) and r["source"] in bad)]


def brute_lines(rows):
    key = lambda v: re.sub("[A-Z]", lambda m: m[0].lower(), v.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for r in rows:
        for v in r["text"].split("\n"):
            held[key(v)].add(r["doc_id"])
    gone = lambda r, v: len(key(v)) >= 20 and len(held[key(v)]) >= 3 and r["doc_id"] != max(held[key(v)])
    texts = ["\n".join(v for v in r["text"].split("\n") if not gone(r, v)) for r in rows]
    return [r | {"text": t, "n_chars": len(t)} for r, t in zip(rows, texts, strict=True)]


def brute_near(rows):
    sets = []
    for r in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for e in s:
            holders[e].append(i)
    for i, s in enumerate(sets):
        for j in {j for e in s for j in holders[e] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)), key=lambda k: rows[k]["doc_id"])
                root[b] = a
    return [r for i, r in enumerate(rows) if top(i) == i]


def brute_mix(rows, hashes):
    sizes, by = defaultdict(int), defaultdict(list)
    for r in rows:
        n = len(WORD.findall(r["text"]))
        sizes[r["source"]] += n
        by[r["source"]].append((n, hashes[r["doc_id"]], r))
    order = sorted(sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, free, total = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        rate = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] > 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    target |= {s: rate * weight[s] for s in free}
    out = []
    for s in order:
        copies = min(int(target[s] // sizes[s]), 2)
        budget = max(0, min(sizes[s], round(target[s] - copies * sizes[s]))) if copies < 2 else 0
        lengths = sorted({n for n, _, _ in by[s] if n})
        extra = dict(zip(lengths, mixing.fit_budget(np.array(lengths), np.array([sum(n == v for n, _, _ in by[s]) for v in lengths]), budget).tolist(), strict=True))
        for n in lengths:
            own = sorted((h % (1 << 64), r["doc_id"]) for m, h, r in by[s] if m == n)
            more = {i for _, i in own[: extra[n]]}
            out += [r for m, _, r in by[s] if m == n for _ in range(copies + (r["doc_id"] in more))]
    return out


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_run_is_brute_force(spark):
    """Each stage of run(), on the smallest tables, keeps what brute force keeps of the stage before; packing has every id."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    hashes = {r["doc_id"]: r["h"] for r in docs.select("doc_id", F.xxhash64(F.lit(17), "doc_id").alias("h")).collect()}
    for brute in (brute_quality, brute_lines, brute_near, lambda x: brute_mix(x, hashes)):
        before = len(rows)
        rows = brute(rows)
        assert rows and (brute is brute_lines or len(rows) != before)
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r["doc_id"], tuple(own.encode(r["text"], add_special_tokens=False).ids) + (1,)) for r in rows)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, DATA).collect():
        pieces[r["doc_id"]].append((r["start"], np.frombuffer(r["tokens"], "<u4").tolist(), r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["tier"]))
    for i, got in pieces.items():
        texts = [k for k in want.elements() if k[0] == i]
        assert len({t for _, t in texts}) == 1  # a document twice is the same one
        ids, times = texts[0][1], len(texts)
        seen = Counter()
        for start, part, n in got:
            assert n == len(ids) and tuple(part) == ids[start : start + len(part)]
            seen.update(range(start, start + len(part)))
        assert set(seen.values()) == {times} and len(seen) == len(ids)
    assert set(pieces) == {i for i, _ in want}
    for got in sequences.values():
        at = 0
        for offset, n, tier in sorted(got):
            assert offset == at
            at += n
        assert at == tier


def test_ties_of_near_dedup(spark):
    """Of several rows of one id and text the one whose columns have the least hash stays, equal rows as one."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "en", s, 5) for s in ("a", "b", "c", "c", None)] + [(2, text, "en", "z", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    least = docs.where("doc_id = 1").select("source", F.xxhash64(*docs.columns).alias("h")).orderBy("h").first()["source"]
    for n in (1, 4):
        got = corpus_pipeline.near_dedup(spark, docs.repartition(n), DATA).collect()
        assert [(r["doc_id"], r["source"]) for r in got] == [(1, least)]


def test_line_dedup_without_character_counts(spark):
    docs = spark.createDataFrame([(k, "a line of more than twenty characters", k) for k in range(3)], "doc_id long, text string, row int")
    assert corpus_pipeline.line_dedup(spark, docs, DATA).columns == ["doc_id", "text", "row"]


def _names_written(monkeypatch, module):
    names, put = [], module.written
    monkeypatch.setattr(module, "written", lambda df, name: names.append(name) or put(df, name))
    return names


@pytest.mark.parametrize("most", [quality_rules.BROADCAST_HOSTS, 0])
def test_quality_rules_write_no_texts(spark, monkeypatch, most):
    """The stage keeps brute force's rows, bad hosts and one without a name among them, and writes sums by host only."""
    monkeypatch.setattr(quality_rules, "BROADCAST_HOSTS", most)
    names = _names_written(monkeypatch, quality_rules)
    text = lambda k: " ".join(f"word{k}x{i}" for i in range(12 if k % 7 else 5))
    rows = [{"doc_id": k, "text": text(k) + " #$%" * (h in (3, 8) and k % 3 > 0), "source": None if h == 3 else f"h{h}"} for h in range(30) for k in range(40 * h, 40 * h + 40)]
    want = brute_quality(rows)
    assert any(r["source"] == "h8" for r in want) and sum(r["source"] is None for r in want) < 15
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, text string, source string")
    got = corpus_pipeline.quality_rules(spark, docs, DATA)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in want)
    assert names == ["hosts", "rates"] + ["counts"] * (not most)


def test_small_buckets_move_no_elements(spark, monkeypatch):
    """What hubs leave open in small buckets is settled without a row for each element, with brute force's classes."""
    names = _names_written(monkeypatch, minhash)
    random.seed(6)
    texts = []
    for i in range(60):  # copies at similarities of about 0.4 to 1
        x = [f"b{k}" for k in range(150)]
        for _ in range(random.choice([0, 2, 5, 6, 7, 8, 10, 12])):
            x[random.randrange(len(x))] = f"r{i}"
        texts.append(" ".join(x))
    rows = [{"doc_id": k, "text": t} for k, t in enumerate(texts)]
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), percent=80).where("kept")
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in brute_near(rows))
    assert "likely" in names and not {"apart", "keys"} & set(names)


def test_profiles_bound_what_sets_share():
    rng = np.random.default_rng(2)
    for n in (1, 40, 400, 200_000):  # the last one fills its ranges
        pool = rng.integers(0, 1 << 64, 2 * n, dtype=np.uint64)
        sets = [np.unique(rng.choice(pool, n)) for _ in range(4)]
        profiles, sizes = np.array([minhash.profile(s) for s in sets]), np.array([len(s) for s in sets])
        for i, s in enumerate(sets):
            most = minhash.shared_at_most(profiles[i], len(s), profiles, sizes)
            assert most[i] == len(s)
            assert all(most[j] >= len(np.intersect1d(s, v)) for j, v in enumerate(sets))


def _broadcasts(df):
    """What the plan that ran for ``df`` has below each of its broadcasts."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    out = []
    for i, line in enumerate(plan):
        if "BroadcastExchange" in line:
            depth = line.index("BroadcastExchange")
            below = next((j for j in range(i + 1, len(plan)) if len(plan[j]) - len(plan[j].lstrip(" :|+-*")) <= depth), len(plan))
            out.append("\n".join(plan[i:below]))
    return out


def test_near_dedup_keeps_growing_tables_out_of_the_driver(spark, monkeypatch):
    """Salts multiply rows that Spark estimates as they were before; tables of ids take much more memory than files."""
    rng, found, held = random.Random(3), [], []
    texts = [[f"g{g}_{rng.randrange(10**6)}" for _ in range(60)] for g in range(30)]
    rows = [(10 * g + c, " ".join(t[c:]), "s") for g, t in enumerate(texts) for c in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    write, key = minhash.written, "spark.sql.autoBroadcastJoinThreshold"

    def spied(df, name):
        held.append((name, spark.conf.get(key)))
        found.extend((name, b) for b in (_broadcasts(df) if name in ("labels", "sets", "stay") else []))
        return write(df, name)

    before = spark.conf.get(key)
    spark.conf.set(key, "10485760b")
    try:
        monkeypatch.setattr(minhash, "written", spied)
        monkeypatch.setattr(corpus_pipeline, "written", spied)
        out = corpus_pipeline.near_dedup(spark, docs, DATA)
        assert not _broadcasts(out)
    finally:
        spark.conf.set(key, before)
    assert {v for name, v in held if name != "stay"} == {str(1 << 18)} and dict(held)["stay"] == "10485760b"
    assert not [b for name, b in found if name == "stay" or "salt" in b]
    assert [name for name, b in found if "bitmap_construct_agg" in b] == ["sets"]
    assert sorted(r["doc_id"] for r in out.collect()) == [10 * g for g in range(30)]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_texts_to_read_again_are_told_by_a_bitmap(spark, kind):
    x = spark.range(40_000).selectExpr(f"cast(if(id = 7, null, id) as {kind}) id", "id n")
    got = minhash._some_ids(x, x.where("n % 40 = 7").select("id"), 1000).select("n").collect()
    got = {r["n"] for r in got}
    assert got >= set(range(7, 40_000, 40))
    assert len(got) < 40_000 // 10
