"""Operators against DuckDB, brute force, held-out labels and hostile tables."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.oracle import compare, duck
from tidemark.llm import QUERIES, SQL, chat, embed_dedup, langid, licenses, minhash, mixing, packing, sharding, topk, toxicity
from tidemark.llm.flat import _letters

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node bigint, v string, rank int"
WORDS = re.compile("[^\x20\x09-\x0d]+")


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, folder, name):
    ok, note = compare(QUERIES[name](spark, folder), duck(folder), SQL[name])
    assert ok, note


@pytest.fixture(scope="module")
def hostile(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    texts = [None, "", "   ", "one", "a b c d e f", "a b c d e f", long, long + " end", "Released under the MIT License.", "1234 !!"]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None, 1, "x", 2) for i, t in enumerate(texts)]
    rows += [rows[4], (None, "a b c d e f", "fr", "s", 3, 1, "x", 2), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _labels(spark):
    return spark.createDataFrame([(1, 0, 1), (2, None, None), (None, 1, 1), (4, 0, 0)], "doc_id bigint, quality int, toxic int")


def test_hostile_documents(spark, hostile, empty):
    n = hostile.count()
    assert sharding.assign(hostile).filter("shard is not null").count() == n
    assert mixing.by_document(mixing.mix(hostile)).count() == n
    assert toxicity.score(hostile, _labels(spark)).filter("score between 0 and 1").count() == n
    out = {r["doc_id"]: r for r in langid.identify(hostile).collect() if r["doc_id"] is not None}
    assert out[0]["lang_pred"] == out[1]["lang_pred"] == out[9]["lang_pred"] == "und"
    near = minhash.near_duplicates(hostile, width=3, percent=85).collect()
    assert len(near) == n
    by = {r["doc_id"]: r for r in near if r["doc_id"] is not None}
    assert by[5]["component_id"] == 4 and by[7]["component_id"] == 6 and by[0]["n_shingles"] == 0
    assert [r["doc_id"] for r in licenses.scan(hostile).collect()] == [8]
    pieces = packing.pack(hostile, capacity=100).collect()
    assert sum(r["words"] for r in pieces) == hostile.agg(F.sum(F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)))).first()[0]
    for result in (
        sharding.assign(empty), mixing.mix(empty), licenses.scan(empty), packing.pack(empty), minhash.near_duplicates(empty),
        langid.identify(empty), toxicity.score(empty, _labels(spark)),
    ):
        assert result.count() == 0


def test_hostile_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [nan, 1.0], 1), (6, [0.0, 0.0], 1), (7, [1.0], 1), (None, [1.0, 0.001], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_duplicates(df).collect()}
    assert got == {0: 4, 1: 4, 2: 4, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, None: 4}
    best = topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in best] == [(2, 131072), (1, 65536), (1, 65536), (3, 65536), (6, 0)]
    none = df.filter("false")
    assert embed_dedup.near_duplicates(none).count() == topk.top_k(none, F.lit(True)).count() == 0


def test_hostile_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, None, None, None), (None, 0, "user", "x"), (5, 0, "user", "z"), (5, 0, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: (r["n_turns"], r["text"]) for r in chat.render(df).collect()}
    assert set(got) == {1, 4, 5}
    assert got[1] == (2, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n")
    assert chat.render(df.filter("false")).count() == 0


def _components(links, ids):
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates_by_brute_force(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(60)]
    texts = []
    for _ in range(60):  # one group of copies, from close to loose
        copy = list(base)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8])):
            copy[rng.randrange(60)] = rng.choice(words)
        texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    sets = []
    for t in texts:
        w = WORDS.findall(t)
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} or {tuple(w)})
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    want = _components(links, range(len(sets)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = minhash.near_duplicates(df, width=3, percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in enumerate(sets)}


def test_embedding_links_by_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows)).toPandas().set_index("vec_id")
    total = found = 0
    for _, part in rows.groupby("label"):
        x = np.array(part["embedding"].tolist(), float)
        sims = (x @ x.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)
        np.fill_diagonal(sims, 0)
        true, mine = (sims >= 0.98).sum(1), got.loc[part["vec_id"], "n_links"].to_numpy()
        assert (mine <= true).all()
        total, found = total + true.sum(), found + mine.sum()
    assert found >= 0.9 * total


def test_embedding_search_below_its_recall_fails(spark, monkeypatch):
    vectors = spark.createDataFrame([(i, [1.0, float(i % 3), 0.5], 0) for i in range(6)], "vec_id bigint, embedding array<float>, label bigint")
    monkeypatch.setattr(embed_dedup, "_audit", lambda *_: (0.5, None))
    with pytest.raises(RuntimeError, match="recall of 0.500 after 32 hash tables"):
        embed_dedup.near_duplicates(vectors)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    tox = toxicity.score(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (tox["predicted"] == tox["toxic"]).mean() > 0.9
    lang = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (lang["lang_pred"] == lang["lang"]).mean() > 0.97


def test_kernel_tolerates_gaps():
    row = lambda s: np.array([[ord(c) for c in s]], np.uint32)
    own, gap, other = (float(toxicity.kernel(row(s), row("idiot")[0])[0]) for s in ("idiot", "idxiot", "table"))
    assert own > gap > 0.4 * own and other < 0.1 * own


def test_rare_insults_are_learned_from_all_labels(spark):
    rng = random.Random(11)
    plain = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(7)) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(plain, k=12)) + (" you zworkelbrimt" if i % 100 == 1 else ""), int(i % 100 == 1)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    found = toxicity.score(docs, docs.select("doc_id", "toxic"), rows=200).join(docs.select("doc_id", "toxic"), "doc_id")
    assert found.filter("predicted != toxic").count() == 0


def test_learning_takes_little_memory_of_the_driver(spark):
    """The vectors of the examples reach the driver as flat numbers, not as an object for each."""
    rng = random.Random(8)
    make = lambda n: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n)]
    plain, insults = make(300), make(60)
    said = lambda words, toxic: ". ".join(" ".join([*rng.choices(words, k=4), *rng.choices(insults, k=toxic)]) for _ in range(3))
    rows = [(i, said(plain, int(i % 3 == 0)), int(i % 3 == 0)) for i in range(5000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([r[::2] for r in rows], "doc_id bigint, toxic int")
    tracemalloc.start()
    try:
        model = toxicity.train(docs, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(model.landmarks.words) >= 50
    numbers = 5000 * 4 / 5 * toxicity.SENTENCES * len(model.landmarks.words)
    assert peak < 30 * numbers
    scores = model.score(pa.array([said(plain, 1), said(plain, 0)]))
    assert scores[0] > 0.5 > scores[1]


def test_features_hold_with_dropped_and_replaced_letters():
    words = ["worthless", "pathetic", "stupid", "loser", "moron", "idiot"]
    texts = ["wrthless", "pthetic", "stpid", "lser", "w*rthless", "p4thetic", "st*pid", "l0ser", "m0ron", "1diot", "sxtxuxpxixd"]
    meant = ["worthless", "pathetic", "stupid", "loser", "worthless", "pathetic", "stupid", "loser", "moron", "idiot", "stupid"]
    marks = toxicity.Landmarks(words)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    value = {(int(r), words[j]): float(v) for r, _, j, v in zip(*marks.features(data, offsets))}
    for i, (text, word) in enumerate(zip(texts, meant)):
        unit = np.array([[ord(c) for c in text if c.isalpha()]], np.uint32)
        exact = float(toxicity.kernel(unit, marks.rows[words.index(word)])[0] / marks.own[words.index(word)])
        assert value.get((i, word), 0) == pytest.approx(exact, abs=1e-5) and exact > 0.25


def test_features_are_the_kernel_for_any_pieces(monkeypatch):
    rng = random.Random(3)
    marks = toxicity.Landmarks(["noon", "stupid", "loser"])
    words = ["".join(rng.choice("nostupidler") for _ in range(rng.randint(2, 60))) for _ in range(200)]
    data = np.frombuffer(". ".join(" ".join(words[i : i + 1 + i % 30]) for i in range(0, 200, 30)).encode(), np.uint8)
    want = list(marks.sentences(data, np.array([0, len(data)])))
    monkeypatch.setattr(toxicity, "AT_ONCE", 7)
    got = list(toxicity.Landmarks(marks.words).sentences(data, np.array([0, len(data)])))
    assert np.allclose(np.vstack([v for _, v in want]), np.vstack([v for _, v in got]))
    units = np.zeros((len(words), toxicity.WIDTH), np.uint32)
    for i, word in enumerate(words):
        units[i, : len(word)] = [ord(c) for c in word[: toxicity.WIDTH]]
    for j, row in enumerate(marks.rows):
        exact = np.minimum(toxicity.kernel(units, row) / marks.own[j], 1)
        assert np.allclose(marks._new(units)[:, j], np.where(exact > 0.02, exact, 0), atol=1e-4)


def test_best_fit_is_the_tightest_compatible_bin():
    rng = random.Random(3)
    sizes = sorted((rng.randrange(1, 100) for _ in range(300)), reverse=True)
    sources, clusters = [rng.randrange(4) for _ in sizes], [rng.randrange(-1, 20) for _ in sizes]
    bins = []
    for size, source, cluster, (got, offset) in zip(sizes, sources, clusters, packing.best_fit(sizes, sources, clusters, 100, 2)):
        fits = [(100 - sum(s for s, _, _ in b), n) for n, b in enumerate(bins)]
        fits = [f for f in fits if f[0] >= size and all(c != cluster or c < 0 for _, _, c in bins[f[1]]) and sum(s == source for _, s, _ in bins[f[1]]) < 2]
        want = min(fits)[1] if fits else len(bins)
        if want == len(bins):
            bins.append([])
        assert (got, offset) == (want, sum(s for s, _, _ in bins[want]))
        bins[want].append((size, source, cluster))


def test_license_notices(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    text = docs.filter(F.col("text").contains(licenses.TEMPLATES["MIT"])).select("doc_id").distinct().collect()
    found = licenses.scan(docs).filter("license = 'MIT' and missing = '' and extra = ''").select("doc_id").distinct().collect()
    assert {r[0] for r in text} <= {r[0] for r in found}
    changed = spark.createDataFrame([(1, "x y Licensed under the big Apache License, Version 2.0. z")], "doc_id bigint, text string")
    assert [(r["license"], r["extra"]) for r in licenses.scan(changed).collect()] == [("Apache-2.0", "big")]


def test_license_templates_are_reachable(spark):
    prose = "The river rose in the night and by morning the lower fields were under water."
    rows = [(i, f"{prose} {licenses.TEMPLATES[name]} {prose}") for i, name in enumerate(sorted(licenses.TEMPLATES))]
    rows += [(1000 + i, text) for i, text in enumerate(["Copyright (c) 2019-2021 Some Body. All rights reserved.", "we reserved all rights", "copyright, licensed"])]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).filter("missing = '' and extra = ''")
    names = {}
    for r in found.orderBy("doc_id", "nth").collect():
        names.setdefault(r["doc_id"], []).append(r["license"])
    assert [names.get(i) for i in range(len(licenses.TEMPLATES))] == [[name] for name in sorted(licenses.TEMPLATES)]
    assert names.get(1000) == ["Copyright (c)", "All rights reserved"] and 1001 not in names and 1002 not in names


def test_license_marks_hold_with_differing_words():
    scanner, seen = licenses.Scanner(licenses.TEMPLATES), re.compile(licenses.mark(licenses.TEMPLATES))
    rng = random.Random(5)
    for name, template in licenses.TEMPLATES.items():
        words = template.split()
        for _ in range(20):
            changed = list(words)
            for at in rng.sample(range(len(words)), int(licenses.DIFFERENT * len(words))):
                changed[at] = ""
            text = "zz " + " ".join(w for w in changed if w) + " zz"
            assert seen.search(text) and any(scanner.names.index(name) in owners for *_, owners in scanner.blocks(text)), text


def test_license_versions_and_kinds():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    said = lambda text: [(h[0], h[1]) for h in scanner.scan(text)]
    gnu = "This work is licensed under the GNU General Public License"
    assert said(f"{gnu} v3 or later.") == [("GPL-3.0 (short)", "license")]
    assert said(f"{gnu}, version 3 only.") == [("GPL-3.0", "license")]
    assert said(f"{gnu}, version 1.") == [("GPL-2.0 (other version)", "license")]
    assert said("Licensed under the Apache License, Version 1.1.") == [("Apache-2.0 (other version)", "license")]
    assert said("subject to the terms of the Mozilla Public License, v. 1.1.") in ([], [("MPL-2.0 (other version)", "license")])
    assert said("Licensed under CC BY 3.0.") == [("CC-BY-4.0 (other version)", "license")]
    assert said("MIT License Copyright (c) 2020 Me.") == [("MIT (name)", "license"), ("Copyright (c)", "rights")]
    assert said("# SPDX-License-Identifier: GPL-3.0-or-later") == [("GPL-3.0-or-later (file line)", "license")]
    bullets = licenses.TEMPLATES["BSD-2-Clause"].replace("1. ", "* ").replace("2. ", "* ")
    assert said(bullets) == [("BSD-2-Clause", "license")]


def test_license_ranking_is_by_bytes_saved():
    """The winner of a stretch saves at least as many bytes as any other template confirmed on the same words."""
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, template in licenses.TEMPLATES.items():
        words = template.split()
        keys, plain = [licenses._key(w) for w in words], [licenses._plain(w) for w in words]
        (won,) = [h for h in scanner.scan(template) if h[0] == name]
        rivals = [scanner.ranked(j, words, h) for j in range(len(scanner.names)) for h in scanner.confirm(j, plain, keys, [True] * len(keys))]
        assert won[4] == max(-r[0][1] for r in rivals if r[1][:2] == (0, len(words)) and not r[0][0])


def test_letters_of_all_planes():
    known = _letters() != 0
    assert all(known[c] == chr(c).isalpha() for c in range(0x110000))
    model = langid.Model(["a", "b"], np.ones((1 << langid.BUCKET_BITS, 2)), np.ones(2))
    langs = model.score(pa.array([chr(0x1E900) * 3, chr(0x1D11E), chr(0x10100), "x"]))[0]
    assert langs == ["a", "und", "und", "a"]  # equal scores: the first language


def test_language_stage_rejects_what_was_not_learned(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "xkqz vwpt jjhg qqwx zzkp bvcx nmqz wkjh", "これは長いテキストです。日本語の文章はここにあります。", "123 !!", "", None,
    ]
    rows = spark.createDataFrame([(-1 - i, t, None, None, None) for i, t in enumerate(odd)], docs.schema)
    kept = {r[0] for r in corpus_pipeline.keep_known_language(spark, docs.unionByName(rows), folder).select("doc_id").collect()}
    assert kept == {r[0] for r in docs.filter("text rlike '[a-zA-Z]'").select("doc_id").collect()}


def test_pipeline_stages_on_hostile_rows(spark, folder, hostile, empty):
    out = corpus_pipeline.drop_near_duplicates(spark, hostile, folder)
    assert out.columns == hostile.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out.select("doc_id", "text").collect())
    # 4, 5, its repeat and a null id are one text; 6 and 7 are near copies; texts without words all stay
    assert [(a, b) for a, b, _ in got] == [(False, i) for i in (0, 1, 2, 3, 4, 6, 8, 9)] + [(True, 0)]
    nulls = spark.createDataFrame([(None, f"{w} " + "b c d e f g h i j k l m n o p q r s t u v w x y z", "en", w, 1, 1, "x", 2) for w in "xy"], hostile.schema)
    assert corpus_pipeline.drop_near_duplicates(spark, nulls, folder).count() == 1
    mixed = corpus_pipeline.mix_sources(spark, hostile, folder)
    assert mixed.columns == hostile.columns
    most = {r["text"]: r["n"] for r in hostile.groupBy("text").agg(F.count("*").alias("n")).collect()}
    assert all(r["n"] <= 2 * most[r["text"]] and r["text"] for r in mixed.groupBy("text").agg(F.count("*").alias("n")).collect())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, kept, folder).persist()
        assert after.columns == docs.columns and after.join(kept, docs.columns, "left_anti").count() == 0
        kept = after
    assert minhash.near_duplicates(kept).filter("not kept").count() == 0
    assert QUERIES and corpus_pipeline.run(spark, folder).count() > 0


def test_components_of_chains_cliques_and_stars(spark):
    from tidemark.llm.components import components

    chain = [(i, i + 1) for i in range(1, 40)]
    zigzag = [(100, 150), (150, 110), (110, 140), (140, 120), (120, 105)]
    clique = [(a, b) for a in range(200, 206) for b in range(200, 206)]
    star = [(399, i) for i in range(300, 340)]
    edges = spark.createDataFrame(chain + zigzag + clique + star, "a bigint, b bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    groups = [range(1, 41), [100, 105, 110, 120, 140, 150], range(200, 206), [*range(300, 340), 399]]
    assert got == {node: min(group) for group in groups for node in group}
    assert components(edges.filter("a < 0")).count() == 0
