"""Quality rules: a table of thresholds compiled into one Spark projection.

Every metric is an expression over the text, every rule a bound on a ratio of metrics;
together they are one projection without user functions, shuffle or state, so any number
of rows flows through in the scan stage. Words are runs of characters other than space
and the controls tab to carriage return; lines are split at ``\\n``.

Defined results: a null text counts as empty; an empty text has no words and fails the
length rule; repeated rows are judged alike; an empty table gives no rows. All input
columns stay; a result column replaces an input column of the same name. A text may be
as long as a row may be: work per text is O(n log n) in its words.

Five-word windows are compared by 64-bit hashes of word hashes. Two different windows of
one text are taken for equal with a probability of about n * n / 2**64.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD_GAP = "[ \t-\r]+"
_SYMBOL = r"[#*$%&|<>]"
_WINDOW = 5

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the and to of a is in that was for it on with as be this are by at from "
    "la de le des et les en un du est une pour que qui par dans au sur pas avec "
    "der die und den von mit sich zu nicht das auf für ein im ist dem eine als "
    "el y los se del las su no por para es con al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= top / bottom <= high``, asked only of texts with ``min_words`` words or more.

    ``top`` and ``bottom`` name metrics; without ``bottom`` the metric itself is bounded.
    """

    name: str
    top: str
    bottom: str | None = None
    low: float | None = None
    high: float | None = None
    min_words: int = 0

    def fails(self, metric: Callable[[str], Column]) -> Column:
        """True where the bound is broken, without dividing."""
        scale = metric(self.bottom) if self.bottom else F.lit(1)
        broken = F.lit(False)
        if self.low is not None:
            broken = broken | (metric(self.top) < F.lit(self.low) * scale)
        if self.high is not None:
            broken = broken | (metric(self.top) > F.lit(self.high) * scale)
        return (metric("n_words") >= self.min_words) & broken


#: A text that breaks one of these is bad whatever the other rules say.
BASE_RULES = (
    Rule("words", "n_words", low=10),
    Rule("repeated words", "n_repeat_words", "n_words", high=0.2),
)

#: Ratios a page of prose keeps by a wide margin; short texts are not asked for stop words.
RULES = (
    Rule("mean word length", "word_chars", "n_words", low=2, high=20),
    Rule("symbols per word", "n_symbols", "n_words", high=0.3),
    Rule("exclamations per word", "n_exclaims", "n_words", high=0.3),
    Rule("stop words", "n_stop_words", "n_words", low=0.04, min_words=60),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=0.5),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _long(c: Column) -> Column:
    return c.cast("long")


def _repeated(windows: Column) -> Column:
    """Words covered by windows whose hash is found twice or more."""
    at = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        step = F.transform(p, lambda x, i: F.least(F.lit(_WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(_WINDOW))))
        return F.aggregate(step, F.lit(0), lambda total, n: total + n)

    count = _let(at, lambda s: _let(places(s), covered))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(count)


def _windows(hashes: Column) -> Column:
    """A hash for each run of five words; as many as start within the text."""
    every = F.transform(
        hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, _WINDOW)])
    )
    return F.slice(every, 1, F.greatest(F.size(hashes) - (_WINDOW - 1), F.lit(0)))


def metrics(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """All metrics of a text, as one struct."""

    def of(text: Column, words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \t-\r]"))
        hashes = F.transform(words, lambda w: F.xxhash64(w))
        return F.struct(
            _long(F.size(words)).alias("n_words"),
            _long(F.length(F.array_join(words, ""))).alias("word_chars"),
            _long(F.when(text.rlike(_SYMBOL), F.regexp_count(text, F.lit(_SYMBOL))).otherwise(0)).alias("n_symbols"),
            _long(F.when(text.contains("!"), F.regexp_count(text, F.lit("!"))).otherwise(0)).alias("n_exclaims"),
            _long(_let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))).alias("n_dup_lines"),
            _long(F.size(lines)).alias("n_lines"),
            _long(F.size(F.filter(words, lambda w: w.isin(*stop_words)))).alias("n_stop_words"),
            _long(_let(hashes, lambda h: _let(_windows(h), _repeated))).alias("n_repeat_words"),
        )

    return _let(
        F.coalesce(text, F.lit("")),
        lambda t: _let(F.filter(F.split(t, _WORD_GAP), lambda w: w != ""), lambda w: of(t, w)),
    )


def quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
    base_rules: Sequence[Rule] = BASE_RULES,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """All rows with their metrics, ``base_failed``, ``kept`` and ``broken_rules``.

    ``kept`` is false where a base rule or a rule is broken; ``broken_rules`` names them.
    """
    measured = docs.withColumn("_quality", metrics(F.col(f"`{text_col}`").cast("string"), stop_words))
    metric = lambda name: F.col("_quality")[name]
    names = "n_words word_chars n_symbols n_exclaims n_dup_lines n_lines n_stop_words n_repeat_words".split()
    broken = F.array_compact(
        F.array(*[F.when(r.fails(metric), F.lit(r.name)) for r in (*base_rules, *rules)])
    )
    base_failed = F.lit(False)
    for r in base_rules:
        base_failed = base_failed | r.fails(metric)
    judged = measured.withColumns(
        {n: metric(n) for n in names} | {"base_failed": base_failed, "broken_rules": broken}
    )
    return judged.withColumn("kept", F.size("broken_rules") == 0).drop("_quality")
