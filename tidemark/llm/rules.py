"""Quality rules as learned decision lists.

Statistics of a text are column expressions of the text alone. Rules are learned by sequential covering
from the statistics of labelled rows: a rule grows by threshold conditions that separate rejected from
accepted rows best (information gain), each step from one count of rows by (statistic, bin); it is pruned
on rows that did not grow it, and learning ends with the first rule that does not hold there. The list is
applied as one conditional expression, in order. Everything runs in DataFrame functions; the driver sees
counts of at most statistics x bins rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.scratch import written

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BINS = 32
MAX_RULES = 12
MAX_CONDITIONS = 4
LEAST_COVER = 5  # rejected rows that a rule must cover where it grows
LEAST_PRECISION = 0.7  # share of rejected rows among those a rule covers where it is pruned
WIDTH = 3


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Runs of characters that are not white space."""
    plain = F.trim(F.translate(text, SPACES, " " * len(SPACES)))
    none = F.array().cast("array<string>")
    return _let(plain, lambda x: F.when(x == "", none).otherwise(F.split(x, " +")))


def repeated_words(found: Column) -> Column:
    """Words of an array that lie in a window of three words that occurs twice or more."""
    last = F.greatest(F.size(found) - (WIDTH - 1), F.lit(1))
    windows = F.arrays_zip(*[F.slice(found, i + 1, last) for i in range(WIDTH)], F.sequence(F.lit(1), last))

    def neighbours(ordered: Column) -> Column:
        # equal windows are neighbours in order
        return F.arrays_zip(F.slice(ordered, F.lit(1), last - 1), F.slice(ordered, F.lit(2), last - 1))

    same = lambda pair: (pair["0"]["0"] == pair["1"]["0"]) & (pair["0"]["1"] == pair["1"]["1"]) & (pair["0"]["2"] == pair["1"]["2"])
    pairs = F.filter(_let(F.sort_array(windows), neighbours), same)
    starts = F.sort_array(F.array_distinct(F.flatten(F.transform(pairs, lambda pair: F.array(pair["0"]["3"], pair["1"]["3"])))))
    none = F.struct(F.lit(-WIDTH).alias("last"), F.lit(0).cast("bigint").alias("n"))
    step = lambda have, i: F.struct(i.alias("last"), (have["n"] + F.least(F.lit(WIDTH), i - have["last"])).alias("n"))
    covered = F.aggregate(starts, none, step, lambda have: have["n"])
    return F.when(F.size(found) > WIDTH, covered).otherwise(F.lit(0).cast("bigint"))


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _counts(text_col: str) -> dict[str, Column]:
    """Counts of a text, all 0 for null and empty texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(F.translate(line, SPACES, " " * len(SPACES))) != "")
    of_lines = lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("distinct"))
    of_words = lambda x: F.struct(
        F.size(x).cast("bigint").alias("all"), F.length(F.array_join(x, "")).cast("bigint").alias("chars"), repeated_words(x).alias("repeated")
    )
    return {
        "_words": _let(words(text), of_words),
        "_lines": _let(lines, of_lines),
        "n_symbols": _removed(text, SYMBOLS).cast("bigint"),
        "_upper": _removed(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "_marks": F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit(""))),
        "_stops": F.length(text) - F.length(F.replace(text, F.lit("."), F.lit(""))),
    }


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """doc_id, ``more``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the counts that only
    the learned rules read."""
    counted = df.select(F.col(id_col).alias("doc_id"), *more, *[c.alias(n) for n, c in _counts(text_col).items()])
    split = {
        "n_words": F.col("_words.all"),
        "word_chars": F.col("_words.chars"),
        "n_repeat_words": F.col("_words.repeated"),
        "n_dup_lines": (F.col("_lines.all") - F.col("_lines.distinct")).cast("bigint"),
        "_lines": F.col("_lines.all"),
    }
    return counted.withColumns(split).drop("_words")


def shares() -> dict[str, Column]:
    """What rules test, all from the counts of ``statistics``; null where undefined."""
    c = F.col
    per_word = lambda x: F.try_divide(c(x), c("n_words"))
    per_char = lambda x: F.try_divide(c(x), c("word_chars"))
    return {
        "words": c("n_words").cast("double"),
        "word_length": per_word("word_chars"),
        "symbol_share": per_char("n_symbols"),
        "repeat_share": per_word("n_repeat_words"),
        "dup_line_share": F.try_divide(c("n_dup_lines"), c("_lines")),
        "upper_share": per_char("_upper"),
        "mark_share": per_char("_marks"),
        "stop_share": per_char("_stops"),
        "words_per_line": F.try_divide(c("n_words"), c("_lines")),
    }


@dataclass(frozen=True)
class Condition:
    """``name >= bound`` or ``name < bound``. A null statistic meets no condition."""

    name: str
    above: bool
    bound: float

    def column(self) -> Column:
        test = F.col(self.name) >= self.bound if self.above else F.col(self.name) < self.bound
        return F.coalesce(test, F.lit(False))

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.bound:.6g}"


Rule = tuple[Condition, ...]


def meets(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def _gain(bad: int, good: int, bad0: int, good0: int) -> float:
    """Information gained for the rejected rows that stay covered."""
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0)))


def _grow(rows: DataFrame, names: list[str], bounds: dict[str, list[float]]) -> Rule:
    """Add the condition with the highest gain until no accepted row is covered or nothing gains. Equal
    gains: the first statistic and bound."""
    rule: Rule = ()
    bins = F.array(*[F.struct(F.lit(i).alias("s"), F.col(f"_bin_{n}").alias("b")) for i, n in enumerate(names)])
    while len(rule) < MAX_CONDITIONS:
        cells = rows.filter(meets(rule)).select("bad", F.explode(bins).alias("x")).groupBy("x.s", "x.b")
        counts = {(r["s"], r["b"]): (r["bad"], r["n"] - r["bad"]) for r in cells.agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect()}
        bad0 = sum(v[0] for k, v in counts.items() if k[0] == 0)
        good0 = sum(v[1] for k, v in counts.items() if k[0] == 0)
        if not bad0 or (rule and not good0):
            break
        best, found = 1e-9, None
        for i, name in enumerate(names):
            for at, bound in enumerate(bounds[name]):
                for above in (True, False):
                    side = [v for (s, b), v in counts.items() if s == i and b is not None and (b > at) == above]
                    bad, good = sum(v[0] for v in side), sum(v[1] for v in side)
                    if bad >= LEAST_COVER and (gain := _gain(bad, good, bad0, good0)) > best:
                        best, found = gain, Condition(name, above, bound)
        if found is None:
            break
        rule += (found,)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix of the rule that does best, (bad - good) / covered, on rows that did not grow it; the
    shorter of equal ones. With it the rejected and accepted rows it covers there."""
    cuts = [rule[: i + 1] for i in range(len(rule))]
    sums = []
    for i, cut in enumerate(cuts):
        sums += [F.count_if(meets(cut) & (F.col("bad") == 1)).alias(f"bad{i}"), F.count_if(meets(cut) & (F.col("bad") == 0)).alias(f"good{i}")]
    row = rows.agg(*sums).first()
    worth = [(row[f"bad{i}"] - row[f"good{i}"]) / max(row[f"bad{i}"] + row[f"good{i}"], 1) for i in range(len(cuts))]
    i = max(range(len(cuts)), key=lambda i: (worth[i], -i))
    return cuts[i], row[f"bad{i}"], row[f"good{i}"]


def learn(rows: DataFrame, names: list[str], bins: int = BINS, max_rules: int = MAX_RULES) -> list[Rule]:
    """Rules that reject, in order, from ``rows``: ``names`` (double), ``bad`` (0/1) and ``grows`` (whether
    a row grows rules, or prunes them).

    Bounds are quantiles of each statistic over all rows, its values rounded to about 1 % first, so that
    one task holds few distinct values however many rows there are. No rows, or none of one kind, give no
    rules.
    """
    q = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    near = {n: F.when(F.col(n) > 0, F.exp(F.round(F.ln(n), 2))).otherwise(F.when(F.col(n) <= 0, 0.0)) for n in names}
    row = rows.agg(*[F.percentile(near[n], q).alias(n) for n in names]).first()
    bounds = {n: sorted(set(row[n] or [])) for n in names}
    binned = rows.withColumns({f"_bin_{n}": F.when(F.col(n).isNotNull(), sum((F.col(n) >= b).cast("int") for b in bounds[n]) if bounds[n] else F.lit(0)) for n in names})
    left = written(binned)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        rule = _grow(left.filter("grows"), names, bounds)
        if not rule:
            break
        rule, bad, good = _prune(left.filter(~F.col("grows")), rule)
        if bad == 0 or bad < LEAST_PRECISION * (bad + good):
            break
        rules.append(rule)
        left = left.filter(~meets(rule))
    return rules


def fired(rules: list[Rule]) -> Column:
    """Number of the first rule (from 1) that a row meets, 0 if none."""
    out = F.lit(0)
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(meets(rule), F.lit(i)).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def train(counted: DataFrame, labels: DataFrame) -> list[Rule]:
    """Learn from the rows of ``statistics`` that pass the base rule and have a quality label (0: bad). Two
    thirds of them, by crc32 of the id, grow rules; the rest prune them."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("quality"))
    rows = counted.filter(~base_failed()).join(known, F.col("doc_id") == F.col("id"))
    bad = F.when(F.col("quality") < 1, 1).otherwise(0).alias("bad")
    grows = (F.pmod(F.crc32(F.col("id").cast("string")), F.lit(3)) != 0).alias("grows")
    return learn(written(rows.select(*[c.alias(n) for n, c in shares().items()], bad, grows)), list(shares()))


def apply(counted: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept and rule (number of the first rule that a row meets,
    0 if none) of rows of ``statistics``."""
    tested = counted.withColumns(shares()).withColumns({"base_failed": base_failed(), "rule": fired(rules)})
    keep = ~F.col("base_failed") & (F.col("rule") == 0)
    return tested.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", keep.alias("kept"), "rule")


def judge(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Quality verdict of every row of ``df`` by the base rule and by a decision list learned from
    ``labels`` (doc_id, quality): see ``apply`` for the columns. Texts are read once.

    Defined results: null and empty texts have 0 in all counts and fail the base rule; repeated rows give
    repeated results; a document labelled twice counts as bad if one label says so; null labels teach
    nothing, and without labels of both kinds no rule is learned, so only the base rule decides; an empty
    table gives an empty table; other columns of ``df`` are not read.
    """
    counted = written(statistics(df, id_col, text_col))
    return apply(counted, train(counted, labels))
