"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language inside tasks and sums them (buckets x languages rows, a bound that
does not grow with the data). The log-probability matrix is broadcast; scoring gathers the rows of the
n-grams that occur and sums them per text in numpy.

The posterior of a whole text is near 1 whatever its language, so it does not show a language that was never
learned. The fit does: the mean log probability of a letter's n-grams, on a scale where 0 is its mean over
the training texts of the predicted language and -1 that of n-grams that these never hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.flat import letters, text_slices

BUCKET_BITS = 15
TRAIN_ROWS = 20_000
_MULTIPLIER = np.uint32(0x9E3779B1)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(modulus)) == remainder


def hash_sample(df: DataFrame, id_col: str, text_col: str, bound: int, seed: int) -> DataFrame:
    """About ``bound`` rows (all, if fewer), chosen by a hash of id and text: no order, no single task, and
    rows whose ids are null or repeated are chosen one by one."""
    total = df.count()
    if total <= bound:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), F.lit(1 << 30)) < int(bound / total * (1 << 30)))


def _ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the 1-, 2- and 3-grams around each letter (what is no letter counts as a space), and
    the first letter of each text."""
    _, chars, first = letters(data, offsets)
    here = np.flatnonzero(chars)
    before = np.zeros(len(chars), np.uint32)
    after = np.zeros(len(chars), np.uint32)
    before[1:], after[:-1] = chars[:-1], chars[1:]
    heads = first[:-1][first[:-1] < len(chars)]
    before[heads] = 0
    after[heads[heads > 0] - 1] = 0
    c, b, a = chars[here], before[here], after[here]
    shift = np.uint32(32 - BUCKET_BITS)
    one = (c * _MULTIPLIER) ^ np.uint32(0x51ED270B)
    two = (one ^ (b * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
    three = (two ^ (a * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    two, three = two ^ (two >> np.uint32(15)), three ^ (three >> np.uint32(13))
    return [x * _MULTIPLIER >> shift for x in (one, two, three)], np.searchsorted(here, first)


class Model:
    """Languages and their log probabilities: ``table`` is buckets x languages, ``prior`` one a language."""

    def __init__(self, langs: list[str], counts: np.ndarray, docs: np.ndarray, alpha: float = 0.5):
        self.langs = langs
        smooth = counts + alpha
        self.table = np.ascontiguousarray(np.log(smooth / smooth.sum(0)).astype(np.float32))
        self.prior = np.log((docs + 1) / (docs.sum() + len(docs))) if len(docs) else np.zeros(0)
        letters_seen = np.maximum(counts.sum(0) / 3, 1)  # three n-grams a letter
        self.usual = (counts * self.table).sum(0) / letters_seen
        self.span = np.maximum(self.usual - 3 * self.table.min(0), 1e-6) if len(langs) else self.usual

    def score(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Languages, posteriors, fits and numbers of letters (``und``: score and fit 0)."""
        langs, scores, fits, sizes = [], [], [], []
        for _, data, offsets in text_slices(texts):
            grams, first = _ngrams(data, offsets)
            total = np.zeros((len(offsets) - 1, len(self.langs)))
            full = np.flatnonzero(first[1:] > first[:-1])
            if len(full) and len(self.langs):
                for j in range(len(self.langs)):
                    column = np.ascontiguousarray(self.table[:, j])
                    each = column[grams[0]] + column[grams[1]] + column[grams[2]]
                    total[full, j] = np.add.reduceat(each, first[full], dtype=np.float64)
                fit = (total / np.maximum(np.diff(first), 1)[:, None] - self.usual) / self.span
                total[full] += self.prior
                best = total.argmax(1)
                share = np.exp(total - total.max(1, keepdims=True))
                top = (share.max(1) / share.sum(1)).clip(0, 1)
            empty = first[1:] == first[:-1]
            for i in range(len(empty)):
                known = not empty[i] and bool(self.langs)
                langs.append(self.langs[best[i]] if known else "und")
                scores.append(float(top[i]) if known else 0.0)
                fits.append(float(fit[i, best[i]]) if known else 0.0)
            sizes.append(np.diff(first))
        whole = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        return langs, np.array(scores, np.float64), np.array(fits, np.float64), whole.astype(np.int64)


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", rows: int = TRAIN_ROWS) -> Model:
    """Fit on the rows of ``df`` with a language, about ``rows`` of them chosen by a hash of id and text."""
    known = hash_sample(df.filter(F.col(lang_col).isNotNull()), id_col, text_col, rows, 10)
    known = known.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            for row, data, offsets in text_slices(batch.column(0)):
                grams, first = _ngrams(data, offsets)
                mine = np.array(names[row : row + len(offsets) - 1], dtype=object)
                for lang in set(mine):
                    here = np.repeat(mine == lang, np.diff(first))
                    held = counts.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
                    for g in grams:
                        held += np.bincount(g[here], minlength=1 << BUCKET_BITS)
                    docs[lang] = docs.get(lang, 0) + int((mine == lang).sum())
        for lang, held in counts.items():
            used = np.flatnonzero(held)
            size = len(used) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size), pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(held[used], docs[lang]), pa.int64())],
                names=["lang", "bucket", "n"],
            )

    summed = known.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(summed["lang"].unique().to_pylist())
    bucket, n = summed["bucket"].to_numpy(), summed["n"].to_numpy()
    counts, docs = np.zeros((1 << BUCKET_BITS, len(langs))), np.zeros(len(langs))
    for j, lang in enumerate(langs):
        mine = pc.equal(summed["lang"], lang).to_numpy()
        inner = mine & (bucket >= 0)
        counts[bucket[inner], j] = n[inner]
        docs[j] = n[mine & (bucket < 0)].sum()
    return Model(langs, counts, docs)


_RESULT = T.StructType([
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("fit", T.DoubleType()), T.StructField("letters", T.LongType())
])


def predict(df: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Struct (lang_pred, score, fit, letters) of a text column of ``df``; one Arrow batch at a time."""
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(_RESULT)
    def run(texts: pa.Array) -> pa.Array:
        langs, *numbers = held.value.score(texts)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), *map(pa.array, numbers)], names=["lang_pred", "score", "fit", "letters"])

    return run(F.col(text_col).cast("string"))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per row of ``df``: doc_id, held_out, lang_pred, score (posterior of the best language).

    The model learns from rows that are not held out (crc32 of the id modulo 4 is not 2) and have a
    language. Defined results: a null text, or one without a letter, gives ``und`` and score 0, and so
    does every text if there is nothing to learn from; repeated rows give repeated results; ties go to
    the language that sorts first; an empty table gives an empty table. Other columns are not read.
    """
    model = train(df.filter(~held_out(id_col, 4, 2)), text_col, lang_col, id_col, rows)
    out = df.select(F.col(id_col).alias("doc_id"), held_out(id_col, 4, 2).alias("held_out"), predict(df, model, text_col).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")
