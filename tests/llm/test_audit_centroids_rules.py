"""Perfect-hash audit, incremental k-means and decision lists: edge cases, brute force, plans."""

import hashlib
import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import centroids, divergence, rules

DOCS = "doc_id bigint, text string, lang string, source string, term string, slot int, rule int, quality int"
WORD = re.compile("[^\x20\x09-\x0d]+")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module")
def hostile(spark):
    long = " ".join(f"w{i % 977}x" for i in range(40_000))
    texts = [None, "", " \t\n", "one", "a b c a b c a", "Straße ÉTÉ été a", "a b\n\na b\n  \na b ", "😀 a😀b \x00 c", long, "x\x0bx\x0cx x x x"]
    rows = [(i, t, ["en", None, ""][i % 3], None if i % 2 else "s", "t", 1, 2, 3) for i, t in enumerate(texts)] * 2
    rows += [(None, "a b c", "fr", "s", None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def _audit(rows, least, top):
    """rows: (lang, source, text). The contract, term by term."""
    rows = [tuple(x or "" for x in r) for r in rows]
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [(lang, source, TERM.findall(text.translate(upper))) for lang, source, text in rows]
    docs = Counter((lang, t) for lang, _, ts in words for t in set(ts))
    kept = defaultdict(set)
    for (lang, t), n in docs.items():
        if n >= least:
            kept[lang].add(t)
    counts = defaultdict(Counter)
    for lang, source, ts in words:
        counts[lang, source].update(t for t in ts if t in kept[lang])
    of_lang = defaultdict(Counter)
    for (lang, _), c in counts.items():
        of_lang[lang].update(c)
    share = lambda c, t, v: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * v)
    out = set()
    for (lang, source), c in counts.items():
        v = len(kept[lang])
        p = {t: share(c, t, v) for t in kept[lang]}
        found = []
        for (other_lang, other), c2 in counts.items():
            if other_lang == lang and other != source:
                found.append((-sum(abs(p[t] - share(c2, t, v)) for t in p), other.encode(), other))
        out |= {(lang, source, "pair", item, -value, i) for i, (value, _, item) in enumerate(sorted(found), 1)}
        q = {t: share(of_lang[lang], t, v) for t in p}
        found = sorted((q[t] - p[t], t.encode(), t) for t in p if c[t] > 0 and p[t] > q[t])[:top]
        out |= {(lang, source, "term", item, -value, i) for i, (value, _, item) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize("shard_terms,broadcast_bytes", [(1 << 16, 1 << 26), (3, 200)])
def test_audit_matches_brute_force(spark, shard_terms, broadcast_bytes, monkeypatch):
    monkeypatch.setattr(divergence, "TILE_CELLS", 20)
    rng = random.Random(3)
    vocabulary = ["été", "Été", "a", "B", "straße", "naïve", "ﬁ", "日本", "zz", "q", "r", "s"]
    rows = [(rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "é", "z", None]), rng.choice([" ", "-", "1"]).join(rng.choices(vocabulary, k=rng.randint(0, 9)))) for _ in range(300)]
    rows += [("xx", "s1", "rare words"), ("xx", "s2", None), ("fr", "empty", ""), *[("en", "hot", "a a a zz")] * 150]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    got = [tuple(r) for r in divergence.audit(df, least=20, top=4, shard_terms=shard_terms, broadcast_bytes=broadcast_bytes).collect()]
    assert len(got) == len(set(got))
    assert set(got) == _audit(rows, 20, 4)


def test_audit_of_hostile_tables(spark, hostile):
    rows = [(r["lang"], r["source"], r["text"]) for r in hostile.collect()]
    got = [tuple(r) for r in divergence.audit(hostile, least=2).collect()]
    assert set(got) == _audit(rows, 2, 50) and len(got) == len(set(got))
    assert divergence.audit(hostile.filter("false")).count() == 0


def test_perfect_hash_is_minimal_and_verifies(spark):
    words = [f"w{i}é" for i in range(5000)]
    made = pickle.loads(pickle.dumps(divergence.PerfectHash(pa.array(words, pa.large_string()))))
    slots = made.find(pa.array(words, pa.large_string()))
    assert sorted(slots) == list(range(5000))
    assert made.stored.take(pa.array(slots)).to_pylist() == words
    assert set(made.find(pa.array([f"x{i}" for i in range(5000)], pa.large_string()))) == {-1}
    with pytest.raises(RuntimeError):
        divergence.PerfectHash(pa.array(["a", "a"], pa.large_string()))


def test_dense_counters_are_given_out_when_full(spark, monkeypatch):
    rows = [("en", f"s{i % 7}", "a b c d") for i in range(70)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    want = set(map(tuple, divergence.audit(df).collect()))
    monkeypatch.setattr(divergence, "DENSE_CELLS", 5)
    assert set(map(tuple, divergence.audit(df).collect())) == want


def _lloyd(rows, k, rounds):
    """rows: (vec_id, whole-number vector)."""
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    c = [np.array(x) for _, x in order[:k]]
    near = lambda x: min((int(((np.array(x) - m) ** 2).sum()), i) for i, m in enumerate(c))
    for _ in range(rounds):
        of = [near(x)[1] for _, x in rows]
        for i in range(len(c)):
            mine = [x for (_, x), j in zip(rows, of) if j == i]
            if mine:
                c[i] = np.array([sum(v) // len(mine) for v in zip(*mine)])
    return [(v, near(x)[1], near(x)[0]) for v, x in rows], c


def test_centroids_match_plain_rounds(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 4)) * rng.choice([1, 5, 40], size=(300, 1))
    data[100:120] = data[0]
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(data)] + [(7, [9.0, 9.0, 9.0, 9.0]), (7, [9.0, 9.0, 9.0, 9.0])]
    got = centroids.cluster(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5), k=6, rounds=4, width=4).collect()
    want, c = _lloyd([(i, [int(np.floor(1024 * v)) for v in x]) for i, x in rows], 6, 4)
    assert Counter((r["vec_id"], r["cluster"], r["distance"]) for r in got) == Counter(want)
    for r in got:
        assert r["cluster_inertia"] == sum(d for _, j, d in want if j == r["cluster"]) and r["inertia"] == sum(d for _, _, d in want)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, c[r["cluster"]].tolist())).encode()).hexdigest()


def test_centroids_of_hostile_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.5, 0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]), (7, []), (8, [-0.0001, 0.0])]
    df = spark.createDataFrame([(i, v, 1, [2], 3) for i, v in rows], "vec_id bigint, embedding array<double>, cluster int, x array<int>, norm int")
    got = centroids.cluster(df, k=8, width=2).collect()
    assert sorted((r["vec_id"] or 0, r["distance"]) for r in got) == [(0, 0), (1, 0), (1, 0), (8, 0)]
    assert len({r["cluster"] for r in got}) == 3  # of two equal centroids the smaller number takes the vectors
    assert centroids.cluster(df.filter("false"), width=2).count() == 0
    assert centroids.cluster(df, k=1, width=2, rounds=0).select("inertia").distinct().count() == 1
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e9, 0.0])], "vec_id bigint, embedding array<double>"), width=2).collect()


def _statistics(text):
    text = text or ""
    found = WORD.findall(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_match_brute_force(spark, folder, hostile):
    for df in (spark.read.parquet(f"{folder}/documents.parquet"), hostile):
        got = rules.statistics(df, "doc_id", "text", F.col("text").alias("said")).collect()
        assert len(got) == df.count()
        for r in got:
            assert tuple(r[n] for n in NAMES) == _statistics(r["said"])


def test_judge_on_hostile_tables(spark, hostile):
    labels = spark.createDataFrame([(3, 1, None), (3, 0, 1), (4, None, 0), (None, 0, 0)], "doc_id bigint, quality int, toxic int")
    rows = rules.judge(hostile, labels).collect()
    assert len(rows) == hostile.count()
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed)
    assert rules.judge(hostile.filter("false"), labels).count() == 0
    assert rules.judge(hostile, labels.filter("false")).count() == hostile.count()


def test_rules_learn_what_was_planted(spark):
    """Bad: many symbols, or long words together with short lines; some labels are wrong."""
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        a, b, c = rng.random(), rng.random(), rng.random()
        bad = a > 0.8 or (b > 0.6 and c < 0.3)
        rows.append((a, b, c if i % 50 else None, int(bad if rng.random() > 0.02 else not bad), i % 3 != 0))
    df = spark.createDataFrame(rows, "a double, b double, c double, bad int, grows boolean")
    learned = rules.learn(df, ["a", "b", "c"])
    assert 2 <= len(learned) <= 4
    assert {(x.name, x.above) for x in learned[0]} == {("a", True)}
    assert {("b", True), ("c", False)} <= {(x.name, x.above) for x in learned[1]}
    wrong = df.select((F.col("bad") == (rules.fired(learned) > 0).cast("int")).alias("ok")).filter("not ok").count()
    assert wrong / len(rows) < 0.06
    assert rules.learn(df.filter("bad = 0"), ["a", "b", "c"]) == rules.learn(df.filter("false"), ["a", "b", "c"]) == []


def test_quality_verdict_on_held_back_labels(spark):
    """Rules learned from half of the labels find most bad documents of the other half and keep good ones."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    half = F.pmod(F.crc32(F.concat(F.lit("h"), F.col("doc_id").cast("string"))), F.lit(2)) == 0
    counted = rules.written(rules.statistics(spark.read.parquet(f"{folder}/documents.parquet")))
    got = rules.apply(counted, rules.train(counted, labels.filter(half))).join(labels.filter(~half), "doc_id")
    row = got.agg(
        F.avg(F.when((F.col("quality") == 1) & ~F.col("base_failed"), F.col("kept").cast("int"))).alias("good"),
        F.avg(F.when(F.col("quality") == 0, 1 - F.col("kept").cast("int"))).alias("bad"),
    ).first()
    assert row["good"] > 0.97 and row["bad"] > 0.7


def test_rules_stay_in_the_engine(spark, folder):
    df = rules.judge(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    plan = df._jdf.queryExecution().toString() + rules.statistics(spark.read.parquet(f"{folder}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Exchange", plan)
