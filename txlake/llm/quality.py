"""Quality rules as a short-circuit cascade.

Each rule is one condition on the text. Its cost (seconds a row, without what a job costs anyway) and its
selectivity (share of rows it rejects) are measured on a bounded sample; the rules are then tried in the
order of rejections per cost, and a text leaves the cascade at the first rule that rejects it. The order
changes the time only: a text is kept if and only if no rule rejects it. Everything is one projection
without a shuffle.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import SPACE, bind, column, text_of, words
from txlake.session import stage

WINDOW = 5
# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


class Figures:
    """The figures of one text, each an expression of its own that is evaluated only where it is used."""

    def __init__(self, text: Column, found: Column | None = None):
        self.text = text_of(text)
        self.found = words(self.text) if found is None else found

    @property
    def n_words(self) -> Column:
        return F.size(self.found).cast("long")

    @property
    def word_chars(self) -> Column:
        """Code points inside words."""
        return F.length(F.array_join(self.found, "")).cast("long")

    @property
    def n_stutter(self) -> Column:
        """Words that equal the word before."""
        return bind(self.found, stutter)

    @property
    def n_symbols(self) -> Column:
        return F.length(F.regexp_replace(self.text, f"[^{SYMBOLS}]+", "")).cast("long")

    @property
    def n_upper(self) -> Column:
        return F.length(F.regexp_replace(self.text, r"\P{Lu}+", "")).cast("long")

    @property
    def n_letters(self) -> Column:
        return F.length(F.regexp_replace(self.text, r"\P{L}+", "")).cast("long")

    @property
    def _worded(self) -> Column:
        return F.filter(F.split(self.text, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]"))

    @property
    def n_lines(self) -> Column:
        """Lines with a word."""
        return F.size(self._worded).cast("long")

    @property
    def n_dup_lines(self) -> Column:
        """Lines with a word that equal an earlier line."""
        return bind(self._worded, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")

    @property
    def n_repeat_words(self) -> Column:
        """Words inside windows of five that are found twice or more in the text, the first included."""
        return bind(word_hashes(self.found), lambda h: bind(window_hashes(h), repeated_words))


class Returned(Figures):
    """Figures of which some are columns already; the others are evaluated where a rule asks for them."""

    COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def __getattribute__(self, name: str):
        return F.col(name) if name in Returned.COLUMNS else super().__getattribute__(name)


def stutter(found: Column) -> Column:
    return F.size(F.filter(found, lambda w, i: F.coalesce(F.get(found, i - 1) == w, F.lit(False)))).cast("long")


def word_hashes(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


def window_hashes(hashes: Column) -> Column:
    """A 64-bit hash of every window of five words."""
    starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    return F.when(F.size(hashes) < WINDOW, F.array().cast("array<bigint>")).otherwise(windows)


def repeated_words(windows: Column) -> Column:
    """Words covered by windows that are there twice or more.

    Most texts repeat none, which a hash set tells in linear time; for the others the windows are
    sorted, and each repeated one covers the words up to the next.
    """
    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def same(a: Column, x: Column, k: Column) -> Column:
        return F.coalesce(F.get(a, k)["h"] == x["h"], F.lit(False))

    def starts(a: Column) -> Column:
        twice = F.filter(a, lambda x, k: same(a, x, k - 1) | same(a, x, k + 1))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def cover(at: Column) -> Column:
        gaps = F.transform(at, lambda x, k: F.coalesce(F.least(F.get(at, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)

    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
        bind(bind(by_hash, starts), cover)
    )


@dataclass(frozen=True)
class Rule:
    """``rejects`` gives a condition on the figures of a text, never null."""

    name: str
    rejects: Callable[[Figures], Column]


#: Thresholds are wide: clean prose in any script passes.
RULES = (
    Rule("few words", lambda f: f.n_words < 10),
    Rule("repeated words", lambda f: 100 * f.n_repeat_words > 20 * f.n_words),
    Rule("symbols", lambda f: 10 * f.n_symbols > f.n_words),
    Rule("repeated lines", lambda f: (f.n_dup_lines > 0) & (2 * f.n_dup_lines > f.n_lines)),
    Rule("long words", lambda f: f.word_chars > 100 * f.n_words),
    Rule("stutter", lambda f: 5 * f.n_stutter > f.n_words),
    Rule("capitals", lambda f: (f.n_letters >= 20) & (2 * f.n_upper > f.n_letters)),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def draw(docs: DataFrame, id_col: str, text_col: str, sample_rows: int) -> DataFrame:
    """(text) of ``sample_rows`` rows at most, drawn from all of ``docs`` by the hash of their ids and written
    once to the shared folder; texts do not reach the driver."""
    n = docs.count()
    # Four fifths of the bound are expected, so that it seldom cuts anything off.
    share = 1.0 if n <= sample_rows else 0.8 * sample_rows / n
    key = F.xxhash64(F.lit(11), column(docs, id_col).cast("string"))
    drawn = docs.where(F.shiftrightunsigned(key, 11) <= F.lit(int(share * (1 << 53))))
    return stage(drawn.select(column(docs, text_col).cast("string").alias("text")).limit(sample_rows), "rule-sample")


def measure(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample_rows: int = 500, id_col: str = "doc_id",
) -> list[Measured]:
    """Cost and selectivity of each rule on ``sample_rows`` rows at most, best rejection per cost first.

    Each rule runs on the same rows, once to compile it and then twice for the time; the time of a
    job that only finds the length of the texts is taken off. Without rows all rules are equal and stay
    in the given order.
    """
    sample = draw(docs, id_col, text_col, sample_rows)

    def timed(value: Column) -> tuple[float, float]:
        job, seconds, share = sample.agg(F.avg(value.cast("double"))), [], None
        for _ in range(3):
            begin = time.monotonic()
            share = job.first()[0]
            seconds.append(time.monotonic() - begin)
        return min(seconds[1:]), share or 0.0

    empty, _ = timed(F.length("text"))
    found = []
    for rule in rules:
        seconds, share = timed(rule.rejects(Figures(F.col("text"))))
        # A tenth of a millisecond is below what can be told from the job around it.
        found.append(Measured(rule, max(seconds - empty, 1e-4), share))
    return sorted(found, key=lambda m: -m.gain)


def passes(figures: Figures, ordered: list[Rule]) -> Column:
    """True if no rule rejects the text; the rules after the first rejecting one are not evaluated."""
    if not ordered:
        return F.lit(True)
    chain = F.when(ordered[0].rejects(figures), F.lit(False))
    for rule in ordered[1:]:
        chain = chain.when(rule.rejects(figures), F.lit(False))
    return chain.otherwise(F.lit(True))


def keep_good(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample_rows: int = 500, id_col: str = "doc_id",
) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns.

    Null and empty texts have no words and are rejected by "few words". Repeated rows get the same
    verdict each; other columns play no part, whatever their names. An empty table gives an empty one. A
    very long text takes time in proportion to its words, by a logarithm more if windows repeat.
    """
    ordered = [m.rule for m in measure(docs, rules, text_col, sample_rows, id_col)]
    text = column(docs, text_col)
    # Nearly every rule needs the words: they are found once, the rest of each rule where it is reached.
    return docs.where(bind(words(text), lambda found: passes(Figures(text, found), ordered)))


def figures_and_verdict(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 500,
) -> DataFrame:
    """Per row: its id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed`` (the first two of ``RULES``) and ``kept``, the verdict of the cascade of ``rules``.

    One row for each row of ``docs``, null ids and repeated rows included; a null text has no words; other
    columns play no part, whatever their names. The five figures are asked for of every text and are
    evaluated once; whatever else a rule needs is evaluated where the cascade reaches the rule, and not
    for texts that an earlier rule or the base rules reject.
    """
    ordered = [m.rule for m in measure(docs, rules, text_col, sample_rows, id_col)]
    text = column(docs, text_col)
    lazy = Figures(F.col("text"))
    found = docs.select(column(docs, id_col).alias("doc_id"), text_of(text).alias("text"), words(text).alias("found"))
    hashed = found.select("doc_id", "text", "found", word_hashes(F.col("found")).alias("hashes"))
    windows = hashed.select("doc_id", "text", "found", window_hashes(F.col("hashes")).alias("windows"))
    figures = windows.select(
        "doc_id", "text", "found", F.size("found").cast("long").alias("n_words"),
        F.length(F.array_join("found", "")).cast("long").alias("word_chars"),
        repeated_words(F.col("windows")).alias("n_repeat_words"),
        *[getattr(lazy, name).alias(name) for name in ("n_symbols", "n_dup_lines")],
    )
    known = Returned(F.col("text"), F.col("found"))
    base_failed = RULES[0].rejects(known) | RULES[1].rejects(known)
    verdict = F.when(base_failed, F.lit(False)).otherwise(passes(known, ordered))
    return figures.select("doc_id", *Returned.COLUMNS, base_failed.alias("base_failed"), verdict.alias("kept"))
