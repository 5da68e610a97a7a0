"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule names the columns it reads; the cascade makes a column where the first rule that reads it stands, so a document that an early
rule rejects does not pay for the later ones.  The order is greedy by rejection per cost, both from one aggregate over a sample: which rules fail
together, so that a rule counts only what those before it leave, and how much work each column and rule has there.  Work is counted (characters
passed over, elements visited), not timed, so one table always gives one order.  The order changes cost only, never the verdict.

Defined cases: a null or empty text has no words and fails the base rule; a null doc_id stays null; repeated rows are judged one by
one; an empty table gives an empty result; extra columns, whatever their names, are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
#: Work of an element that a lambda visits, goes into a hash set or is sorted, in characters passed over by a built-in function.
_VISIT, _ADD, _SORT = 5.0, 5.0, 20.0
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A rejection: fails is true for a document to drop, needs are the columns of _COLUMNS that it reads, work is what it does beyond making these."""

    name: str
    fails: Column
    needs: tuple[str, ...]
    work: Column | None = None


def _held(text: Column, chars: str) -> Column:
    """How many characters of text are in chars."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space and \\x09-\\x0D."""
    return F.filter(F.split(F.translate(text, _BLANKS[1:], " " * 5), " "), lambda w: w != "")


def _fenced(c: Column) -> Column:
    """c, in a form that no filter is pushed through: an optimizer that moves a filter below an array column would evaluate the array inside each lambda that reads it, and one that moves a later rule's column below an earlier rule would undo the cascade."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def _window_hashes() -> Column:
    at = lambda i: F.get("_words", i)
    windows = F.transform(F.sequence(F.lit(0), F.size("_words") - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))
    return F.when(F.size("_words") < 3, F.array().cast("array<bigint>")).otherwise(windows)


def _repeated_windows() -> Column:
    """Sorted (hash, place) of the 3-word windows; empty where all differ, which a hash set tells without a sort."""
    placed = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct("_hashes")) == F.size("_hashes"), F.array().cast("array<struct<h:bigint,p:int>>")).otherwise(placed)


def _repeat_places() -> Column:
    near = lambda i: F.get("_windows", i)["h"]
    again = F.filter("_windows", lambda x, i: F.coalesce(x["h"] == near(i - 1), F.lit(False)) | F.coalesce(x["h"] == near(i + 1), F.lit(False)))
    return F.sort_array(F.transform(again, lambda x: x["p"]))


def _covered_words() -> Column:
    step = F.transform("_places", lambda p, i: F.coalesce(F.least(F.lit(3), F.get("_places", i + 1) - p), F.lit(3)))
    return F.aggregate(step, F.lit(0), lambda a, x: a + x).cast("long")


def _chars(times: float = 1.0) -> Column:
    return times * F.length("_text")


#: The columns that rules read, over _text: what each is made from, how, and with how much work.
_COLUMNS: dict[str, tuple[tuple[str, ...], Callable[[], Column], Callable[[], Column]]] = {
    "_words": ((), lambda: words_of(F.col("_text")), lambda: _chars(2.0) + _VISIT * F.size("_words")),
    "n_words": (("_words",), lambda: F.size("_words").cast("long"), lambda: F.lit(1)),
    "word_chars": ((), lambda: (F.length("_text") - _held(F.col("_text"), _BLANKS)).cast("long"), _chars),
    "n_symbols": ((), lambda: _held(F.col("_text"), SYMBOLS), _chars),
    "_lines": ((), lambda: F.filter(F.split("_text", "\n"), lambda x: F.translate(x, _BLANKS, "") != ""), lambda: _chars(2.0) + _VISIT * F.size("_lines")),
    "_n_lines": (("_lines",), lambda: F.size("_lines").cast("long"), lambda: F.lit(1)),
    "n_dup_lines": (("_lines",), lambda: (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"), lambda: _ADD * F.size("_lines")),
    "_hashes": (("_words",), _window_hashes, lambda: 3 * _VISIT * F.size("_words")),
    "_windows": (("_hashes",), _repeated_windows, lambda: _ADD * F.size("_hashes") + (_VISIT + _SORT) * F.size("_windows")),
    "_places": (("_windows",), _repeat_places, lambda: 3 * _VISIT * F.size("_windows") + _SORT * F.size("_places")),
    "n_repeat_words": (("_places",), _covered_words, lambda: 2 * _VISIT * F.size("_places")),
}


def _all_needs(names: Sequence[str]) -> set[str]:
    """The named columns and those they are made from."""
    return set(names).union(*[_all_needs(_COLUMNS[n][0]) for n in names])


def with_columns(d: DataFrame, names: Sequence[str]) -> DataFrame:
    """d with the named columns of _COLUMNS, and those they are made from."""
    for name in names:
        if name not in d.columns:
            needs, made, _ = _COLUMNS[name]
            d = with_columns(d, needs).withColumn(name, _fenced(made()))
    return d


def base_rules() -> list[Rule]:
    n = F.col("n_words")
    return [Rule("too_short", n < 50, ("n_words",)), Rule("repeats", 100 * F.col("n_repeat_words") > 50 * n, ("n_words", "n_repeat_words"))]


def rules() -> list[Rule]:
    """The rules beyond the base ones."""
    text, n = F.col("_text"), F.col("n_words")
    return [
        Rule("symbols", 10 * F.col("n_symbols") > n, ("n_words", "n_symbols")),
        Rule("word_length", (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 12 * n), ("n_words", "word_chars")),
        Rule("dup_lines", 100 * F.col("n_dup_lines") > 40 * F.col("_n_lines"), ("_n_lines", "n_dup_lines")),
        Rule("shouting", 100 * _held(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") > 40 * F.col("word_chars"), ("word_chars",), _chars()),
        Rule("exclamations", 100 * _held(text, "!") > 30 * n, ("n_words",), _chars()),
        Rule("digits", 100 * _held(text, "0123456789") > 40 * F.col("word_chars"), ("word_chars",), _chars()),
        Rule("few_words", F.size(F.array_distinct("_words")) < 15, ("_words",), _ADD * F.size("_words")),
    ]


@dataclass(frozen=True)
class Pattern:
    """The sampled documents that fail the same rules: which (by place), their number, the work of each column and of each rule over them."""

    fails: tuple[bool, ...]
    n: int
    columns: dict[str, float]
    own: tuple[float, ...]


def cascade(needs: Sequence[Sequence[str]], patterns: Sequence[Pattern], made: Sequence[str] = ()) -> list[int]:
    """The rules' places in greedy order: next is always the one that rejects most of what is left for the work it does there, columns made before being free; ties keep the given order."""
    left, there, rest, order = list(patterns), _all_needs(made), list(range(len(needs))), []

    def worth(i: int) -> float:
        new = _all_needs(needs[i]) - there
        work = sum(p.own[i] + sum(p.columns[c] for c in new) for p in left)
        return sum(p.n for p in left if p.fails[i]) / max(work, 1.0)

    while rest:
        best = max(rest, key=worth)
        order.append(best)
        rest.remove(best)
        there |= _all_needs(needs[best])
        left = [p for p in left if not p.fails[best]]
    return order


def ordered_rules(docs: DataFrame, found: Sequence[Rule], sample_rows: int = 2000, made: Sequence[str] = ()) -> list[Rule]:
    """The rules in the order of cascade() on a sample, where the columns `made` are there anyway.

    The sample is a hash range of the documents, as wide as their number asks for to hold about sample_rows of them. One aggregate reads it; a row for
    each set of rules that fail together, at most one for each sampled document, reaches the driver."""
    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))).select(F.coalesce("text", F.lit("")).alias("_text"))
    columns = sorted(_all_needs([c for r in found for c in r.needs]))
    d = with_columns(sample, columns).select(
        F.array(*[F.coalesce(r.fails, F.lit(False)) for r in found]).alias("fails"),
        F.array(*[_COLUMNS[c][2]().cast("double") for c in columns]).alias("columns"),
        F.array(*[(F.lit(1) if r.work is None else r.work).cast("double") for r in found]).alias("own"),
    )
    total = lambda name, k: F.array(*[F.sum(F.get(name, i)) for i in range(k)]).alias(name)
    rows = d.groupBy("fails").agg(F.count("*").alias("n"), total("columns", len(columns)), total("own", len(found))).collect() if found else []
    patterns = [Pattern(tuple(r["fails"]), r["n"], dict(zip(columns, r["columns"], strict=True)), tuple(r["own"])) for r in rows]
    return [found[i] for i in cascade([r.needs for r in found], patterns, made)]


def quality(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every document.

    The counts are asked for of every document, so they are no part of the cascade here; the further rules are."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    d = with_columns(d, (*COUNTS, "_n_lines"))
    failed = F.lit(False)
    for r in base_rules():
        failed = failed | r.fails
    verdict = F.when(F.col("base_failed"), F.lit(False))
    for r in ordered_rules(docs, rules(), sample_rows, (*COUNTS, "_n_lines")):
        verdict = verdict.when(r.fails, F.lit(False))
    return d.withColumn("base_failed", failed).select("doc_id", *COUNTS, "base_failed", verdict.otherwise(F.lit(True)).alias("kept"))


def keep_good(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """The documents that no rule rejects, with all their columns: one pass, a filter for each rule, in the order of the sample."""
    d = docs.select(F.coalesce("text", F.lit("")).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    for r in ordered_rules(docs, [*base_rules(), *rules()], sample_rows):
        d = with_columns(d, r.needs).filter(~F.coalesce(r.fails, F.lit(False)))
    return d.select("_row.*")
