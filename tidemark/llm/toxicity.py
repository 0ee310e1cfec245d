"""Toxic texts by a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

The kernel of two strings sums, over all subsequences of three letters that they share, a factor DECAY
for each letter that the subsequence spans, so letters put in between lower it but do not end it.
Strings are the units of a sentence: the letters of a word (other characters are dropped, single
letters in a row are joined). Landmarks are the letter runs that set labelled toxic texts apart most
(signed likelihood ratio). The features of a sentence are, for each landmark, the largest kernel value
of its units as a share of the landmark's own, to the power POWER; they are whitened by the landmarks' kernel matrix and a
linear SVM with squared hinge loss is fitted on sentences. A text gives its worst
sentence as the example, chosen anew after each fit, and scores as its worst sentence does.

The kernel is above 0 only if a unit has three letters of a landmark (repeated ones counted as often as the
landmark has them), so all others get 0 for it. It is a product of sparse vectors, which have a weight for each
triple of letters: a unit's triples are looked up among those of all landmarks, once for each distinct unit. A
task keeps the values of the units that it has seen, and a sentence takes the largest of its units' values.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.flat import _MULTIPLIER, letters, mix, text_slices
from tidemark.llm.langid import held_out
from tidemark.plans.scalar_stats import constants
from tidemark.plans.scratch import written

DECAY = 0.6
WIDTH = 24  # letters of a unit that are compared at once; longer units are covered by overlapping windows
POWER = 4  # of the kernel (again a kernel): what only shares a few triples counts less
LANDMARKS = 96
TRAIN_ROWS = 8_000  # labelled texts to fit the weights on, at most about so many; landmarks come from all
SEEN = 50_000  # distinct units whose values a task keeps
AT_ONCE = 1 << 16  # units whose values are gathered at once
FILTER_BITS = 1 << 24  # of the maps that keep most other rows from a shuffle
SENTENCES = 3  # of each such text: those that come nearest to the landmarks


def kernel(units: np.ndarray, landmark: np.ndarray, decay: float = DECAY) -> np.ndarray:
    """Gap-weighted kernel for subsequences of three letters, of each row of ``units`` (0: no letter)."""
    rows, square = len(units), decay * decay
    one = np.zeros((len(landmark) + 1, rows), np.float32)
    two = np.zeros_like(one)
    out = np.zeros(rows, np.float32)
    for i in range(units.shape[1]):
        match = units[:, i] == landmark[:, None]
        run1 = np.zeros(rows, np.float32)
        run2 = np.zeros(rows, np.float32)
        add1, add2 = np.zeros_like(one), np.zeros_like(two)
        for j in range(len(landmark)):
            m = match[j]
            out += square * m * two[j]
            run2 = decay * run2 + square * m * one[j]
            run1 = decay * run1 + square * m
            add1[j + 1], add2[j + 1] = run1, run2
        one = decay * one + add1
        two = decay * two + add2
    return out


def _as_row(word: str) -> np.ndarray:
    return np.array([ord(c) for c in word], np.uint32)


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Letters of a slice; of each unit its first letter, length, sentence and row."""
    points, chars, first = letters(data, offsets)
    space = (points <= 0x20) | (points == 0xA0)
    end = space.copy()
    end[1:] &= np.isin(points[:-1], [0x2E, 0x21, 0x3F])
    end |= points == 0x0A
    heads = first[:-1][first[:-1] < len(points)]
    space[heads], end[heads] = True, True
    here = np.flatnonzero(chars)
    token, sentence = np.cumsum(space)[here], np.cumsum(end)[here]
    begins = np.flatnonzero(np.diff(token, prepend=-1))
    length = np.diff(begins, append=len(here))
    single = length == 1
    of = sentence[begins]
    joined = single[1:] & single[:-1] & (of[1:] == of[:-1])
    begins = begins[np.concatenate([[True], ~joined])] if len(begins) else begins
    length = np.diff(begins, append=len(here))
    row = np.searchsorted(first, here[begins], side="right") - 1
    return chars[here], begins, length, sentence[begins], row


class Landmarks:
    def __init__(self, words: list[str]):
        self.words = words
        self.rows = [_as_row(w) for w in words]
        self.seen = np.zeros(0, np.uint64)
        self.values = np.zeros((0, len(words)), np.float32)
        self.own = np.array([float(kernel(r[None, :], r)[0]) for r in self.rows])
        self._triples()

    def _triples(self) -> None:
        """Numbers of the letters, pairs and triples of the landmarks (0: none has it), and for each triple
        the landmarks that have it, with weights."""
        weight: dict[tuple, dict[int, float]] = {}
        for j, row in enumerate(self.rows):
            for a, b, c in combinations(range(len(row)), 3):
                mine = weight.setdefault((int(row[a]), int(row[b]), int(row[c])), {})
                mine[j] = mine.get(j, 0.0) + DECAY ** (c - a + 1)
        self.letters = np.unique(np.concatenate([np.zeros(1, np.uint32), *self.rows]))
        number = {int(c): i for i, c in enumerate(self.letters)}
        pairs = {p: i + 1 for i, p in enumerate(sorted({t[:2] for t in weight}))}
        self.pair = np.zeros((len(number), len(number)), np.int32)
        self.triple = np.zeros((len(pairs) + 1, len(number)), np.int32)
        for (a, b), i in pairs.items():
            self.pair[number[a], number[b]] = i
        for i, t in enumerate(weight):
            self.triple[pairs[t[:2]], number[t[2]]] = i + 1
        owners = list(weight.values())
        self.first = np.cumsum([0, 0, *map(len, owners)])
        self.owner = np.array([j for mine in owners for j in mine], np.int64)
        self.weight = np.array([w / self.own[j] for mine in owners for j, w in mine.items()], float)

    def white(self) -> np.ndarray:
        """Inverse square root of the normalized kernel matrix."""
        m = len(self.words)
        matrix = np.empty((m, m))
        for i, a in enumerate(self.rows):
            for j, b in enumerate(self.rows):
                matrix[i, j] = kernel(a[None, :], b)[0] / np.sqrt(self.own[i] * self.own[j])
        values, vectors = np.linalg.eigh(((matrix + matrix.T) / 2) ** POWER)
        return (vectors / np.sqrt(np.maximum(values, 0) + 0.05)) @ vectors.T

    def _new(self, units: np.ndarray) -> np.ndarray:
        """Features of units (0: no letter), one row each."""
        place = np.minimum(np.searchsorted(self.letters, units), len(self.letters) - 1)
        known = np.where(self.letters[place] == units, place, 0).T.copy()
        columns = [np.flatnonzero(c) for c in known]
        parts = []
        for i, at in enumerate(columns[:-2]):
            for j in range(i + 1, len(columns) - 1):
                pair = self.pair[known[i][at], known[j][at]]
                some = np.flatnonzero(pair)
                if not len(some):
                    continue
                rows, pair = at[some], pair[some]
                for k in range(j + 1, len(columns)):
                    if not len(columns[k]):
                        continue
                    triple = self.triple[pair, known[k][rows]]
                    hit = np.flatnonzero(triple)
                    parts.append((rows[hit], triple[hit], np.full(len(hit), DECAY ** (k - i + 1))))
        if not parts:
            return np.zeros((len(units), len(self.rows)), np.float32)
        rows, triple, value = (np.concatenate(x) for x in zip(*parts))
        many = self.first[triple + 1] - self.first[triple]
        begin = np.repeat(self.first[triple] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        cells = np.repeat(rows, many) * len(self.rows) + self.owner[begin]
        out = np.bincount(cells, np.repeat(value, many) * self.weight[begin], len(units) * len(self.rows))
        out = np.minimum(out, 1).astype(np.float32).reshape(len(units), len(self.rows))
        return np.where(out > 0.02, out, np.float32(0))

    def _look_up(self, chars: np.ndarray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of distinct units, and which of them each unit is; units are told apart by 64-bit hashes."""
        size = np.minimum(ends - at, WIDTH)
        codes = size.astype(np.uint64)
        for k in range(int(size.max())):
            more = np.flatnonzero(size > k)
            codes[more] = mix(codes[more] * _MULTIPLIER + chars[at[more] + k])
        codes, first, which = np.unique(codes, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.seen, codes), max(len(self.seen) - 1, 0))
        known = self.seen[place] == codes if len(self.seen) else np.zeros(len(codes), bool)
        values = np.zeros((len(codes), len(self.rows)), np.float32)
        values[known] = self.values[place[known]]
        fresh = np.flatnonzero(~known)
        for some in np.array_split(fresh, -(-len(fresh) // (AT_ONCE // 4)) or 1):
            places = at[first[some], None] + np.arange(WIDTH)
            values[some] = self._new(np.where(places < ends[first[some], None], chars[np.minimum(places, len(chars) - 1)], 0))
        if len(self.seen) + len(fresh) <= SEEN:
            codes_now = np.concatenate([self.seen, codes[fresh]])
            order = np.argsort(codes_now)
            self.seen, self.values = codes_now[order], np.concatenate([self.values, values[fresh]])[order]
        return values, which

    def sentences(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and features of the sentences of a slice, in order, some at a time."""
        chars, begins, length, sentence, row = _units(data, offsets)
        if not len(begins) or not self.words:
            return
        unit, at = np.arange(len(begins)), begins
        if (length > WIDTH).any():  # windows that overlap by half, up to the end of the unit
            extra = np.where(length > WIDTH, -(-2 * (length - WIDTH) // WIDTH), 0)
            unit = np.repeat(unit, extra + 1)
            step = np.arange(len(unit)) - np.repeat(np.cumsum(extra + 1) - extra - 1, extra + 1)
            at = begins[unit] + step * (WIDTH // 2)
        ends, of = (begins + length)[unit], sentence[unit]
        heads = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))
        n = 0
        while n < len(heads) - 1:
            m = max(n + 1, int(np.searchsorted(heads, heads[n] + AT_ONCE, side="right")) - 1)
            worst = np.zeros((m - n, len(self.rows)), np.float32)
            for lo in range(heads[n], heads[m], AT_ONCE):  # more than once only for a single long sentence
                hi = min(lo + AT_ONCE, heads[m])
                values, which = self._look_up(chars, at[lo:hi], ends[lo:hi])
                cuts = heads[n:m] - lo if m - n > 1 else np.zeros(1, np.int64)
                worst = np.maximum(worst, np.maximum.reduceat(values[which], cuts))
            yield row[unit[heads[n:m]]], worst
            n = m

    def features(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Non-zero features of the sentences of a slice: row, sentence (from 0), landmark, value."""
        parts, count = [], 0
        for rows, values in self.sentences(data, offsets):
            i, j = np.nonzero(values)
            parts.append((rows[i], i + count, j, values[i, j]))
            count += len(rows)
        if not parts:
            return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.float32),)
        return tuple(np.concatenate(x) for x in zip(*parts))


class Model:
    def __init__(self, landmarks: Landmarks, weights: np.ndarray, bias: float):
        self.landmarks, self.weights, self.bias = landmarks, weights, bias

    def score(self, texts: pa.Array) -> np.ndarray:
        margin = np.full(len(texts), self.bias)
        for row, data, offsets in text_slices(texts):
            for rows, values in self.landmarks.sentences(data, offsets):
                np.maximum.at(margin, row + rows, values**POWER @ self.weights + self.bias)
        return 1 / (1 + np.exp(np.clip(-2 * margin, -50, 50)))


def _runs(word: str = "word") -> Column:
    """Distinct letter runs of 4 to 8 letters of a word."""
    starts = F.sequence(F.lit(1), F.length(word) - 3)
    ends = lambda i: F.sequence(F.lit(4), F.least(F.lit(8), F.length(word) - i + 1))
    return F.array_distinct(F.flatten(F.transform(starts, lambda i: F.transform(ends(i), lambda n: F.substring(word, i, n)))))


def _landmark_words(texts: DataFrame, count: int) -> list[str]:
    """Letter runs of 4 to 8 letters that are more frequent in toxic texts, the most significant first. All
    significant runs are gone through, so the many runs of one word do not take the places of others.

    Only runs of words of toxic texts can be significant. Those words alone give a run's toxic count and the
    least that its other count can be; the runs that are significant with it are looked for in all words,
    through a bit map of fixed size, and counted in full. What the map lets pass besides fails the final test.
    """
    letters_only = F.lower(F.regexp_replace("text", r"[^\p{L}\s]", ""))
    words = texts.select("toxic", F.explode(F.array_distinct(F.split(letters_only, r"\s+"))).alias("word"))
    words = words.filter(F.length("word") >= 4).groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    words = written(words)
    totals = words.agg(F.sum("bad"), F.sum("good")).first()
    if not totals[0] or not totals[1]:
        return []
    rate = (F.col("bad") + F.col("good")) / float(sum(totals))
    part = lambda c, total: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / float(total) / rate)).otherwise(0.0)
    gain = F.round(part("bad", totals[0]) + part("good", totals[1]), 6).alias("gain")
    count_runs = lambda df: df.groupBy("run").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter("bad >= 2")
    often = F.col("bad") / float(totals[0]) > 2 * (F.col("bad") + F.col("good")) / float(sum(totals))
    every = words.select(F.explode(_runs()).alias("run"), "bad", "good")
    toxic = written(count_runs(words.filter("bad > 0").select(F.explode(_runs()).alias("run"), "bad", "good")))
    least = float(np.log(max(2, toxic.count()))) + 3  # else chance makes some of so many
    able = toxic.filter(often & (gain > least)).select("run")
    runs = count_runs(every.filter(_maybe_in(able, "run"))).filter(often)
    top = written(runs.select("run", gain).filter(F.col("gain") > least))
    chosen: list[str] = []
    for row in top.orderBy(F.desc("gain"), F.desc(F.length("run")), "run").toLocalIterator():
        if len(chosen) == count:
            break
        if not any(_alike(row["run"], c) for c in chosen):
            chosen.append(row["run"])
    return chosen


def _alike(a: str, b: str) -> bool:
    """Whether the longer string has the shorter one but for its first or last letter."""
    short, long = sorted((a, b), key=len)
    return short[1:] in long or short[:-1] in long


def _svm(x: np.ndarray, y: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss (Newton steps); ``each`` is the cost of each row."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.ones(x.shape[1])
    ridge[-1] = 1e-3
    for _ in range(30):
        active = y * (x @ w) < 1
        xa, ca = x[active], each[active][:, None]
        new = np.linalg.solve(np.diag(ridge) + xa.T @ (ca * xa), xa.T @ (ca[:, 0] * y[active]))
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def _maybe_in(keys: DataFrame, name: str) -> Column:
    """Whether the column ``name`` may be among the given keys, by one bit of a map of fixed size for each key's
    hash. A map that is full lets all pass, so what follows must look again."""
    place = F.pmod(F.xxhash64(F.lit(7), name), F.lit(FILTER_BITS))
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    words = keys.select(place.alias("place")).groupBy(F.expr("place div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = keys.sparkSession.range(FILTER_BITS // 64).join(words, F.col("id") == F.col("word"), "left")
    every = written(every.select(F.struct(F.col("id"), F.coalesce("bits", F.lit(0)).alias("bits")).alias("x")))
    table = constants(every, {"bits": F.transform(F.array_sort(F.collect_list("x")), lambda x: x["bits"])})["bits"]
    word = F.get(table, F.floor(place / 64).cast("int"))
    return F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS, count: int = LANDMARKS, cost: float = 50_000.0) -> Model:
    """Fit on the labelled rows that are not held out: landmarks from all of them, weights from about ``rows``, half
    of them toxic if there are so many, chosen by a hash of the id and weighted by the rows that they stand for."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.filter(~held_out(id_col, 5, 0))
    bad, good = known.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).first()
    keep_bad = min(1.0, max(rows // 2, rows - good) / max(bad, 1))
    keep_good = min(1.0, max(rows // 2, rows - bad) / max(good, 1))
    share = F.when(F.col("toxic") > 0, keep_bad).otherwise(keep_good)
    known = known.withColumn("sampled", F.pmod(F.xxhash64(F.lit(5), F.col(id_col)), F.lit(1 << 30)) < share * (1 << 30))
    texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.filter("id is not null").withColumn("hash", F.md5("text"))
    # equal texts are one, named by the least id: hashes and ids only
    marks = texts.select("id", "hash").join(known.withColumnRenamed(id_col, "id"), "id")
    marks = written(marks.groupBy("hash").agg(F.max("toxic").alias("toxic"), F.max("sampled").alias("sampled"), F.min("id").alias("id")))
    mine = texts.filter(_maybe_in(marks.select("id"), "id")).join(marks.hint("merge"), ["id", "hash"]).dropDuplicates(["id", "hash"])
    landmarks = Landmarks(_landmark_words(mine, count))
    size = len(landmarks.words)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, toxic = [], []
            names = batch.column(1).to_pylist()
            for start, data, offsets in text_slices(batch.column(0)):
                table: dict[int, np.ndarray] = {}
                for rows_of, values in landmarks.sentences(data, offsets):
                    heads = np.flatnonzero(np.diff(rows_of, prepend=-1)).tolist()
                    for lo, hi in zip(heads, [*heads[1:], len(rows_of)]):
                        row = int(rows_of[lo])
                        mine = np.concatenate([table[row], values[lo:hi]]) if row in table else values[lo:hi]
                        table[row] = mine[np.lexsort((*mine.T, -mine.sum(1), -mine.max(1)))[:SENTENCES]]
                for row in range(len(offsets) - 1):
                    found.append((table.get(row, np.zeros(size)) ** POWER).ravel().astype(np.float32))
                    toxic.append(names[start + row])
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(found, pa.list_(pa.float32()))], names=["toxic", "x"])

    if not size:
        return Model(landmarks, np.zeros(0), -1.0)
    sampled = marks.filter("sampled").select("id", "hash", "toxic")  # about ``rows`` rows
    sample = texts.join(F.broadcast(sampled), ["id", "hash"]).dropDuplicates(["id", "hash"])
    examples = sample.select("text", "toxic").mapInArrow(nearest, "toxic int, x array<float>").toArrow()  # no object for each number
    bags = [(toxic, x.values.to_numpy().reshape(-1, size)) for toxic, x in zip(examples["toxic"].to_pylist(), examples["x"])]
    bags.sort(key=lambda bag: (bag[0], bag[1].astype(">f4").tobytes()))  # no value is below 0, so bytes sort as the values do
    y = np.array([1.0 if toxic else -1.0 for toxic, _ in bags])
    each = np.where(y > 0, 1 / keep_bad, 1 / keep_good)
    each *= cost / each.sum()
    white = landmarks.white()
    weights, bias = np.ones(size), 0.0
    for turn in range(3):
        worst = np.vstack([x[(x @ weights).argmax() if turn else 0] for _, x in bags])
        w = _svm(worst @ white, y, each)
        weights, bias = white @ w[:-1], float(w[-1])
    return Model(landmarks, weights, bias)


def predict(df: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Score (0 to 1) of a text column of ``df``; one Arrow batch at a time."""
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(held.value.score(texts), pa.float64())

    return run(F.col(text_col).cast("string"))


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per row of ``df``: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    The model learns from rows that have a label and are not held out (crc32 of the id modulo 5 is not
    0). Defined results: null and empty texts, and texts without a letter, score as a text in which
    nothing resembles a landmark; without labels of both kinds every text scores 1/(1+e^2); an id that is
    labelled twice counts as toxic if either label does; a null id is held out; repeated rows give
    repeated results; an empty table gives an empty table. Other columns are not read.
    """
    model = train(df, labels, id_col, text_col, rows)
    out = df.select(F.col(id_col).alias("doc_id"), held_out(id_col, 5, 0).alias("held_out"), predict(df, model, text_col).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
