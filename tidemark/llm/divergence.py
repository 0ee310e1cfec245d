"""Audit of how sources of a language differ in their words: frequencies by perfect-hash recount.

1. Exact filter: documents per (language, term), counted inside tasks slice by slice and summed; terms in
   enough documents are kept.
2. Each language's kept terms are cut by hash into shards of bounded size, and one task per shard builds a
   minimal perfect hash (cascading bit arrays), with the terms stored in slot order.
3. Recount: groups of shards of bounded size are broadcast, and each group takes one scan of the texts. A
   word is looked up by its slot, verified against the stored term, and counted in a dense array for each
   (language, source, shard), which a task gives out as its nonzero slots.
4. Smoothed whole-number frequencies are compared: sources by tiles of bounded size (a difference is only
   worked out where a term occurs; where it does not, all terms share one value), terms by rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.flat import mix, text_slices
from tidemark.plans.scratch import written

LEAST_DOCS = 30
TOP = 50
ADD = 5
SCALE = 1_000_000_000
SHARD_TERMS = 1 << 16  # about so many terms share a perfect hash
BROADCAST_BYTES = 64 << 20  # shards broadcast together; more shards take more scans
DENSE_CELLS = 1 << 22  # counters that a task holds before it gives them out
TILE_CELLS = 1 << 22  # sources x terms that a task compares at once
_MULTIPLIER = 0x9E3779B97F4A7C15
COUNTS = "lang string, source string, shard bigint, slot bigint, term string, n bigint"


def _u64(x: int) -> np.uint64:
    return np.uint64(x & 0xFFFFFFFFFFFFFFFF)


@cache
def _fold() -> np.ndarray:
    """Each byte as it stands in a term (A-Z lower-cased), 0 for what is in none: ASCII but for letters."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    table[0:0x41] = table[0x5B:0x61] = table[0x7B:0x80] = 0
    return table


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of a slice of texts, and the row of each."""
    folded = _fold()[data]
    inside = folded != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    before = np.concatenate([[0], np.cumsum(inside)])
    ends = np.append(before[starts], before[-1])
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(folded[inside]))
    return terms, np.searchsorted(offsets, starts, side="right") - 1


def _hashes(terms: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash of each string of a large_string array (none is empty)."""
    if not len(terms):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
    data = np.frombuffer(terms.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    at = np.arange(len(data)) - np.repeat(starts, np.diff(offsets))
    values = mix(np.arange(1, 257, dtype=np.uint64) * _u64(_MULTIPLIER) + _u64(seed))
    powers = np.cumprod(np.full(int(at.max()) + 1, _u64(_MULTIPLIER + 2 * seed)))
    return mix(np.add.reduceat(values[data] * powers[at], starts))


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash of distinct strings: each string has a slot of its own from 0 to n - 1.

    Level by level, a string that alone has its bit keeps it; those that share a bit go on to the next
    level. A slot is the number of bits before. ``stored`` holds the strings in slot order, so a look-up
    of a string outside the set is noticed.
    """

    def __init__(self, terms: pa.Array):
        for seed in range(64):
            if self._build(terms, seed):
                return
        raise RuntimeError("the strings have no perfect hash: some are equal")

    def _build(self, terms: pa.Array, seed: int) -> bool:
        self.seed, self.levels, left = seed, [], _hashes(terms, seed)
        if len(np.unique(left)) < len(left):
            return False
        while len(left):
            size = max(64, 2 * len(left))
            at = self._at(left, len(self.levels), size)
            used = np.bincount(at, minlength=size) == 1
            self.levels.append(used)
            left = left[~used[at]]
        self._rank()
        slots = self._slots(_hashes(terms, seed))
        order = np.empty(len(slots), np.int64)
        order[slots] = np.arange(len(slots))
        self.stored = terms.take(pa.array(order))
        return True

    def _rank(self) -> None:
        self.ranks, total = [], 0
        for used in self.levels:
            self.ranks.append(total + np.cumsum(used) - used)
            total += int(used.sum())

    @staticmethod
    def _at(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(hashes + _u64((level + 1) * _MULTIPLIER)) % np.uint64(size)).astype(np.int64)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        slots, open_ = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for level, used in enumerate(self.levels):
            at = self._at(hashes[open_], level, len(used))
            hit = used[at]
            slots[open_[hit]] = self.ranks[level][at[hit]]
            open_ = open_[~hit]
        return slots

    def find(self, terms: pa.Array) -> np.ndarray:
        """Slot of each string, -1 for a string outside the set."""
        slots = self._slots(_hashes(terms, self.seed))
        some = np.flatnonzero(slots >= 0)
        same = pc.equal(self.stored.take(pa.array(slots[some])), terms.take(pa.array(some))).to_numpy(zero_copy_only=False)
        slots[some[~same]] = -1
        return slots

    def __getstate__(self) -> dict:
        levels = [(len(used), np.packbits(used).tobytes()) for used in self.levels]
        ends = np.cumsum([0] + pc.binary_length(self.stored).to_pylist())
        return {"seed": self.seed, "levels": levels, "ends": ends, "text": "".join(self.stored.to_pylist()).encode()}

    def __setstate__(self, state: dict) -> None:
        self.seed = state["seed"]
        self.levels = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for n, b in state["levels"]]
        self.stored = pa.LargeStringArray.from_buffers(len(state["ends"]) - 1, pa.py_buffer(state["ends"]), pa.py_buffer(state["text"]))
        self._rank()


def _coded(names: list) -> tuple[np.ndarray, list]:
    """Numbers for names in order of first appearance, and the names."""
    known: dict = {}
    return np.array([known.setdefault(n, len(known)) for n in names], np.int64), list(known)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for row, data, offsets in text_slices(batch.column(2)):
            terms, at = _terms(data, offsets)
            if not len(terms):
                continue
            words = terms.dictionary_encode()
            size = len(words.dictionary)
            once = np.unique(at * size + words.indices.to_numpy())  # a term counts once for each document
            lang, names = _coded(langs[row : row + len(offsets) - 1])
            pairs, n = np.unique(lang[once // size] * size + once % size, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in pairs // size], pa.string()), words.dictionary.take(pa.array(pairs % size)).cast(pa.string()), pa.array(n)],
                names=["lang", "term", "n"],
            )


def kept_terms(texts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term) in at least ``least`` rows of ``texts`` (lang, source, text)."""
    found = texts.mapInArrow(_document_counts, "lang string, term string, n bigint")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("lang", "term")


def _shards(kept: DataFrame, sizes: DataFrame, shard_terms: int) -> DataFrame:
    """(lang, shard, shards, terms, bytes, hash): a pickled perfect hash for each shard of a language."""
    import pickle

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, many = _hashes(batch.column(1).cast(pa.large_string())), batch.column(2).to_numpy()
            shard = np.zeros(len(hashes), np.int64)
            for n in np.unique(many):
                shard[many == n] = _shard_of(hashes[many == n], int(n))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], names=["lang", "term", "shards", "shard"])

    def build(table: pa.Table) -> pa.Table:
        made = PerfectHash(table["term"].combine_chunks().cast(pa.large_string()))
        blob = pickle.dumps(made)
        one = table.slice(0, 1)
        return pa.table({"lang": one["lang"], "shard": one["shard"], "shards": one["shards"], "terms": [len(made.stored)], "bytes": [len(blob)], "hash": [blob]})

    many = sizes.select("lang", F.ceil(F.col("v") / shard_terms).alias("shards"))
    placed = kept.join(many, "lang").select("lang", "term", "shards").mapInArrow(place, "lang string, term string, shards bigint, shard bigint")
    return placed.groupBy("lang", "shard").applyInArrow(build, "lang string, shard bigint, shards bigint, terms bigint, bytes bigint, hash binary")


def _recount(texts: DataFrame, shards: DataFrame) -> DataFrame:
    """Occurrences (lang, source, shard, slot, term, n) of the terms of the given shards, whose size the
    caller bounds: one scan of the texts, written."""
    shards = shards.select("lang", "shard", "shards", "hash").collect()
    held = texts.sparkSession.sparkContext.broadcast({(r["lang"], r["shard"]): bytes(r["hash"]) for r in shards})
    cuts = {r["lang"]: r["shards"] for r in shards}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        hashes = {key: pickle.loads(blob) for key, blob in held.value.items()}
        dense: dict[tuple, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source, shard), counts in dense.items():
                slots = np.flatnonzero(counts)
                one = lambda v, kind: pa.array([v] * len(slots), kind)
                yield pa.RecordBatch.from_arrays(
                    [one(lang, pa.string()), one(source, pa.string()), one(shard, pa.int64()), pa.array(slots), hashes[lang, shard].stored.take(pa.array(slots)).cast(pa.string()), pa.array(counts[slots])],
                    names=["lang", "source", "shard", "slot", "term", "n"],
                )
            dense.clear()

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, data, offsets in text_slices(batch.column(2)):
                terms, at = _terms(data, offsets)
                if not len(terms):
                    continue
                words = terms.dictionary_encode()
                size, index = len(words.dictionary), words.indices.to_numpy()
                group, names = _coded(list(zip(langs[row : row + len(offsets) - 1], sources[row : row + len(offsets) - 1])))
                pairs, n = np.unique(group[at] * size + index, return_counts=True)
                edges = np.searchsorted(pairs, np.arange(len(names) + 1) * size)
                plain = _hashes(words.dictionary)
                found: dict[str, list] = {}  # of each language: shard and slot of each distinct term of the slice
                for g, (lang, source) in enumerate(names):
                    if lang not in cuts:
                        continue
                    if lang not in found:
                        shard, slot = _shard_of(plain, cuts[lang]), np.full(size, -1, np.int64)
                        for s in np.unique(shard):
                            if (lang, s) in hashes:
                                mine = np.flatnonzero(shard == s)
                                slot[mine] = hashes[lang, s].find(words.dictionary.take(pa.array(mine)))
                        found[lang] = [shard, slot]
                    shard, slot = found[lang]
                    mine = pairs[edges[g] : edges[g + 1]] - g * size
                    times = n[edges[g] : edges[g + 1]]
                    known = slot[mine] >= 0
                    mine, times = mine[known], times[known]
                    for s in np.unique(shard[mine]):
                        if (lang, source, s) not in dense:
                            if sum(map(len, dense.values())) + len(hashes[lang, s].stored) > DENSE_CELLS:
                                yield from out()
                            dense[lang, source, s] = np.zeros(len(hashes[lang, s].stored), np.int64)
                        here = shard[mine] == s
                        dense[lang, source, s][slot[mine[here]]] += times[here]
        yield from out()

    found = texts.mapInArrow(count, COUNTS).repartition("lang", "shard", "slot")
    found = written(found.groupBy("lang", "shard", "slot", "source", "term").agg(F.sum("n").alias("n")))
    held.unpersist()
    return found


def _tile(table: pd.DataFrame) -> pd.DataFrame:
    """Parts of the summed differences that the terms of one tile add beyond the value of absent terms:
    (source, other, extra). Rows: a group's absent value (slot -1), or a term's value p in a group."""
    absent = table[table["slot"] < 0].sort_values("source", kind="stable")
    names, base = absent["source"].to_numpy(), absent["p"].to_numpy(np.int64)
    index = {s: i for i, s in enumerate(names)}
    table = table[table["slot"] >= 0]
    _, slot = np.unique(table["slot"].to_numpy(), return_inverse=True)
    p = np.repeat(base[:, None], slot.max() + 1 if len(slot) else 0, axis=1)
    p[table["source"].map(index).to_numpy(np.int64), slot] = table["p"].to_numpy(np.int64)
    width = p.shape[1]
    rows = []
    for i in range(len(names)):
        extra = np.abs(p - p[i]).sum(1) - width * np.abs(base - base[i])
        others = np.flatnonzero(extra != 0)
        rows.append(pd.DataFrame({"source": names[i], "other": names[others], "extra": extra[others]}))
    return pd.concat(rows) if rows else pd.DataFrame({"source": [], "other": [], "extra": []})


def audit(
    df: DataFrame, least: int = LEAST_DOCS, top: int = TOP, shard_terms: int = SHARD_TERMS, broadcast_bytes: int = BROADCAST_BYTES,
    lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """How the sources of each language differ: lang, source, part, item, value, rank.

    Terms are runs of characters that are letters A-Z (lower-cased) or not ASCII. Each language keeps the V
    terms in at least ``least`` of its documents; a group (language and source), or a language, gives a kept
    term ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``, N its occurrences of all kept terms. Part
    ``pair``: each other source of the language by the summed |p - q| over all kept terms. Part ``term``:
    the ``top`` terms of the group with p above the language's, by the difference. All exact.

    Defined results: null text, language or source counts as ''; groups without terms are compared as well;
    a language without kept terms has value 0 for all its pairs; equal values are ranked by item in byte
    order; repeated rows are documents of their own; an empty table gives an empty table; other columns are
    not read. A source of N sources of a language appears in N - 1 pairs, so the result grows with N^2.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    texts = df.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    kept = written(kept_terms(texts, least))
    sizes = written(kept.groupBy("lang").agg(F.count("*").alias("v")))
    shards = written(_shards(kept, sizes, shard_terms))
    scans, room = [], 0
    for r in shards.select("lang", "shard", "bytes").orderBy("lang", "shard").collect():  # a row for each shard
        if not scans or r["bytes"] > room:
            scans.append([r, r])
            room = broadcast_bytes
        scans[-1][1] = r
        room -= r["bytes"]
    counts = df.sparkSession.createDataFrame([], COUNTS).select("lang", "shard", "slot", "source", "term", "n")
    for first, last in scans:
        from_ = (F.col("lang") > first["lang"]) | ((F.col("lang") == first["lang"]) & (F.col("shard") >= first["shard"]))
        to = (F.col("lang") < last["lang"]) | ((F.col("lang") == last["lang"]) & (F.col("shard") <= last["shard"]))
        counts = counts.unionByName(_recount(texts, shards.filter(from_ & to)))

    # exact values: a term's counts meet at (language, shard, slot); N follows from the counts
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
    whole = Window.partitionBy("lang")  # one row for each source
    groups = written(groups.withColumns({"lang_total": F.sum("total").over(whole), "sources": F.count("*").over(whole)}))

    def share(n: str, total: str) -> F.Column:
        return F.expr(f"1 + (cast({SCALE} as decimal(38, 0)) * ({n} + {ADD})) div (cast({total} as decimal(38, 0)) + {ADD} * v)")

    of_lang = F.sum("n").over(Window.partitionBy("lang", "shard", "slot"))
    values = counts.withColumn("lang_n", of_lang).join(groups, ["lang", "source"])
    values = written(values.select("lang", "source", "shard", "slot", "term", "sources", share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q")))

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = values.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)

    # a tile holds so many terms of a shard that sources x terms stay bounded
    tiles = F.greatest(F.ceil(F.col("sources") * F.lit(float(shard_terms)) / TILE_CELLS), F.lit(1))
    tiled = values.withColumn("tile", F.pmod("slot", tiles))
    base = groups.filter("v > 0").select("lang", "source", "v", share("0", "total").alias("p"))
    marks = tiled.select("lang", "shard", "tile").distinct().join(base, "lang")
    cells = tiled.select("lang", "shard", "tile", "slot", "source", "p").unionByName(marks.select("lang", "shard", "tile", F.lit(-1).cast("bigint").alias("slot"), "source", "p"))
    extra = cells.groupBy("lang", "shard", "tile").applyInPandas(lambda key, t: _tile(t).assign(lang=key[0]), "source string, other string, extra bigint, lang string")
    extra = extra.groupBy("lang", "source", "other").agg(F.sum("extra").alias("extra"))
    base = groups.select("lang", "source", "v", F.when(F.col("v") > 0, share("0", "total")).otherwise(0).alias("p"))
    other = base.select("lang", F.col("source").alias("other"), F.col("p").alias("p2"))
    pairs = base.join(other, "lang").filter("source <> other").join(extra, ["lang", "source", "other"], "left")
    value = F.col("v") * F.abs(F.col("p") - F.col("p2")) + F.coalesce("extra", F.lit(0))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), value.alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(ranked))
    return terms.unionByName(pairs).select("lang", "source", "part", "item", F.col("value").cast("bigint"), "rank")


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), words AS MATERIALIZED (
  SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS MATERIALIZED (
  SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= 30
), sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM docs
), counted AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), cells AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, s.v,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS total,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, k.term)::HUGEINT AS lang_n,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang)::HUGEINT AS lang_total
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang) LEFT JOIN counted c USING (lang, source, term)
), shares AS MATERIALIZED (
  SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 5) // (total + 5 * v) AS p,
    1 + 1000000000::HUGEINT * (lang_n + 5) // (lang_total + 5 * v) AS q FROM cells
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
