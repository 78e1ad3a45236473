"""Quality rules by weak supervision (operator 12).

Each rule votes good, bad or abstains on a document.  Nobody labels documents: how often the rules agree tells
how far each can be trusted.  Expectation-maximisation over the counts of vote patterns estimates, for every
rule, how often it is right on good and on bad documents, and the share of good documents.  A document is kept
if its posterior probability of being good is at least a half, instead of having to pass every rule.

All rows are measured and counted in Spark.  A pattern is one of 3 ** rules, so the table of pattern counts
that the iteration reads is bounded by the number of rules, whatever the corpus.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quotemill.llm.common import ship, staged

#: A rule as (measure, scale): vote by comparing 100 * measure with bounds times scale.
#: Good from low to high (both included), bad below worst_low or above worst_high, else it abstains.
RULES: tuple[tuple[str, str, str, float, float, float, float], ...] = (
    # name, measure, scale, worst_low, low, high, worst_high (per hundred of scale)
    ("length", "n_words", "one", 1500, 5000, math.inf, math.inf),
    ("word_length", "word_chars", "n_words", 200, 300, 1000, 1500),
    ("symbols", "n_symbols", "n_words", -1, 0, 2, 10),
    ("repeated_lines", "n_dup_lines", "n_lines", -1, 0, 5, 30),
    ("repeated_windows", "n_repeat_words", "n_words", -1, 0, 5, 20),
    ("capitals", "n_upper", "n_letters", -1, 0, 20, 50),
    ("marks", "n_marks", "word_chars", -1, 0, 15, 30),
    ("variety", "n_distinct", "n_words", 5, 20, 100, 100),
    ("sentence_ends", "n_ends", "n_words", -1, 1, 25, 50),
    ("bare_marks", "n_bare", "n_words", -1, 0, 5, 20),
)
#: Base rules, which no posterior overrules: words at least, and repeated words of a hundred at most.
LEAST_WORDS, MOST_REPEATED = 10, 20

#: Start, least and most of each rule's accuracy on good and on bad documents, and of the share of good ones: a
#: good document trips almost no rule, a bad one trips some of them.  Nothing is believed beyond doubt.
ON_GOOD, ON_BAD, GOOD = (0.99, 0.8, 0.999), (0.3, 0.05, 0.99), (0.9, 0.05, 0.98)
#: Votes as at the start that hold a rule without evidence there.
PSEUDO = 1.0
ITERATIONS = 30

_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"
_CONTINUED = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_EVERY = bytes(range(256))

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
            "n_marks", "n_distinct", "n_ends", "n_bare")


def _only(kept: bytes) -> bytes:
    return bytes(c for c in _EVERY if c not in kept)


_NOT_UPPER, _NOT_LOWER, _NOT_MARKS = _only(_UPPER), _only(_LOWER), _only(_MARKS)


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words covered by windows of ``size`` words that occur twice or more, the first occurrence included."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = end = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + size - max(i, end)
            end = i + size
    return covered


def measure(text: str | None) -> tuple[int, ...]:
    """The MEASURES of one whole text; a null text counts as empty.

    Letters, capitals and marks are those of ASCII; lines are parted by ``\\n`` and count if they hold a word;
    a word ends a sentence if ``.``, ``!`` or ``?`` is its last character; it is bare if it has marks only.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    upper = len(data.translate(None, _NOT_UPPER))
    return (len(words), len(data.translate(None, _BLANKS + _CONTINUED)),
            len(data) - len(data.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words),
            len(lines), upper, upper + len(data.translate(None, _NOT_LOWER)), len(data.translate(None, _NOT_MARKS)),
            len(set(words)), sum(w[-1] in b".!?" for w in words), sum(not w.strip(_MARKS) for w in words))


def measured(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the MEASURES of every row."""
    ship(docs.sparkSession)
    docs = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)], "text")
    kept = StructType([StructField(f.name, f.dataType) for f in docs.schema[:-1]])

    def run(batches):
        for batch in batches:
            rows = [measure(text.as_py()) for text in batch.column(batch.num_columns - 1)]
            made = [pa.array(column, pa.int64()) for column in zip(*rows)] or [pa.array([], pa.int64())] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], *MEASURES])

    made = docs.mapInArrow(run, StructType(kept.fields + [StructField(m, LongType()) for m in MEASURES]))
    return made.toDF(*keep, *MEASURES)


def vote(rule) -> Column:
    """1 (good), -1 (bad) or 0 (abstains); where the scale is 0 there is nothing to judge."""
    _, what, scale, worst_low, low, high, worst_high = rule
    x = 100 * F.col(what)
    of = F.lit(1).cast("long") if scale == "one" else F.col(scale)
    bad = F.lit(False)
    if worst_low > 0:
        bad = bad | (x < int(worst_low) * of)
    if worst_high < math.inf:
        bad = bad | (x > int(worst_high) * of)
    good = x >= int(low) * of
    if high < math.inf:
        good = good & (x <= int(high) * of)
    return F.when(of <= 0, 0).when(bad, -1).when(good, 1).otherwise(0)


def pattern(rules=RULES) -> Column:
    """Votes of all rules as one number, two more than a vote being one digit to base 3."""
    out = F.lit(0).cast("long")
    for rule in rules:
        out = out * 3 + vote(rule) + 1
    return out


def votes_of(code: int, rules: int) -> list[int]:
    out = []
    for _ in range(rules):
        code, digit = divmod(code, 3)
        out.append(digit - 1)
    return out[::-1]


def posterior(votes: list[int], share: float, on_good: list[float], on_bad: list[float]) -> float:
    """Probability that a document with these votes is good; an abstention says nothing."""
    x = math.log(share / (1 - share))
    for v, g, b in zip(votes, on_good, on_bad):
        if v > 0:
            x += math.log(g / (1 - b))
        elif v < 0:
            x += math.log((1 - g) / b)
    return 1 / (1 + math.exp(-x))


def estimate(counts: dict[int, int], rules: int, iterations: int = ITERATIONS) -> tuple[float, list[float], list[float]]:
    """Share of good documents and each rule's accuracy on good and on bad ones, from pattern counts."""
    rows = [(n, votes_of(code, rules)) for code, n in sorted(counts.items())]
    total = sum(counts.values())
    share, good, bad = GOOD[0], [ON_GOOD[0]] * rules, [ON_BAD[0]] * rules
    if not total:
        return share, good, bad

    def accuracy(bounds, right: float, every: float) -> float:
        start, least, most = bounds
        return min(most, max(least, (right + PSEUDO * start) / (every + PSEUDO)))

    for _ in range(iterations):
        at = [(n, v, posterior(v, share, good, bad)) for n, v in rows]
        share = min(GOOD[2], max(GOOD[1], math.fsum(n * q for n, _, q in at) / total))
        good = [accuracy(ON_GOOD, math.fsum(n * q for n, v, q in at if v[j] > 0),
                         math.fsum(n * q for n, v, q in at if v[j])) for j in range(rules)]
        bad = [accuracy(ON_BAD, math.fsum(n * (1 - q) for n, v, q in at if v[j] < 0),
                        math.fsum(n * (1 - q) for n, v, q in at if v[j])) for j in range(rules)]
    return share, good, bad


def judge(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), rules=RULES) -> DataFrame:
    """``keep``, the MEASURES, ``base_failed``, ``posterior`` and ``kept`` of every row.

    One row out per row in: null and empty texts have no words and fail the base rules, repeated rows get equal
    results, an empty table gives none.  Every row, base failures included, counts in the estimate.  Names in
    ``keep`` must differ from the columns added; other columns of ``docs`` are not looked at.
    """
    clash = set(keep) & {*MEASURES, "_pattern", "base_failed", "posterior", "kept"}
    if clash:
        raise ValueError(f"columns {sorted(clash)} would be hidden by the measures; rename or leave them out")
    rows = staged(measured(docs, keep).withColumn("_pattern", pattern(rules)), "weak-quality")
    counts = {r["_pattern"]: r["n"] for r in rows.groupBy("_pattern").agg(F.count("*").alias("n")).collect()}
    share, good, bad = estimate(counts, len(rules))
    table = docs.sparkSession.createDataFrame(
        [(c, posterior(votes_of(c, len(rules)), share, good, bad)) for c in sorted(counts)], "_pattern long, posterior double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    # At most 3 ** rules rows.
    out = rows.join(F.broadcast(table), "_pattern").withColumn("base_failed", failed)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
    return out.select(*keep, *MEASURES, "base_failed", "posterior", "kept")
