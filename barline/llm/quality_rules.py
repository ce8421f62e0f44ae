"""Operator 2: quality rules as a short-circuit cascade. DataFrame functions only.

A rule is a boolean Column that says "fails". On a sample, one aggregation
counts how often each combination of rules fails, and each rule is timed several
times, beyond what every rule shares (reading, splitting words, statistics that
are at hand anyway); rules are then ordered by rejections among the rows still
standing per cost. The verdict is a CASE that stops at the first rule that fails,
and statistics are computed inside it, so a row that a cheap, selective rule
rejects never reaches a dear one. The order changes the work, never the verdict.
``verdicts`` returns five statistics of every row, so these are at hand there and
the cascade saves the other three; ``kept_documents`` returns none and saves all.

Edge cases: a null text counts as empty and has no words; rows are judged one
by one, so repeated rows and null doc_ids change nothing; an empty table keeps
the given order; the sample holds only what the rules read; other columns are
ignored. A text of any length is judged whole, in the memory of its own row: an
array of its words, and of its windows' hashes.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: Rows that rules are timed and counted on; the order depends on them, the verdicts do not.
SAMPLE_ROWS = 2000
#: Timings of each rule, of which the median counts.
TIMINGS = 3
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Statistics that the verdicts return for every row.
RETURNED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def let(value: Column, body) -> Column:
    """``body(value)`` with value computed once."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def count_of(text: Column, chars: str) -> Column:
    """How many characters of the text are among ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, "")).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)


def repeat_words(words: Column, size: int = 8) -> Column:
    """Words inside windows of ``size`` words that occur twice or more in the text.

    Windows are compared by their 64-bit hashes within one text. Only texts in
    which a hash repeats sort (hash, place) to find the places.
    """
    def places(hashes):
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: F.filter(F.transform(s, lambda e, k: F.when(
            (e["h"] == F.get(s, k - 1)["h"]) | (e["h"] == F.get(s, k + 1)["h"]), e["i"])), lambda i: i.isNotNull()))

    def covered(at):
        start = F.struct(F.lit(-size).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(F.array_sort(at), start, lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(size), i - acc["last"])).alias("n")),
                           lambda acc: acc["n"])

    def count(hashes):
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(places(hashes), covered))

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) > size, let(hashes, count)).otherwise(F.lit(0).cast("long"))


def echoes(words: Column) -> Column:
    """Words equal to the word before."""
    pairs = F.sequence(F.lit(1), F.size(words) - 1)
    return F.when(F.size(words) > 1, F.size(F.filter(pairs, lambda i: F.get(words, i) == F.get(words, i - 1))).cast("long")).otherwise(F.lit(0).cast("long"))


def features(text: Column, words: Column) -> dict[str, Column]:
    """The statistics that rules read, as expressions over a text and its words (neither null)."""
    return {
        "n_words": F.size(words).cast("long"), "word_chars": word_chars(text), "n_symbols": count_of(text, SYMBOLS),
        "n_dup_lines": let(lines_with_words(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": repeat_words(words), "n_lines": F.size(lines_with_words(text)).cast("long"),
        "n_capitals": count_of(text, CAPITALS), "n_echoes": echoes(words),
    }


def base_rules(f: dict[str, Column]) -> list[Rule]:
    return [Rule("few_words", f["n_words"] < 20), Rule("repeated_windows", f["n_repeat_words"] * 100 > f["n_words"] * 30)]


def rules(f: dict[str, Column]) -> list[Rule]:
    """The rules on features, in integers only."""
    return [
        *base_rules(f),
        Rule("word_length", (f["word_chars"] < f["n_words"] * 2) | (f["word_chars"] > f["n_words"] * 15)),
        Rule("symbols", f["n_symbols"] * 10 > f["n_words"]),
        Rule("repeated_lines", (f["n_dup_lines"] >= 5) & (f["n_dup_lines"] * 10 > f["n_lines"] * 3)),
        Rule("echoes", f["n_echoes"] * 10 > f["n_words"] * 3),
        Rule("capitals", f["n_capitals"] * 2 > f["word_chars"]),
    ]


def on_text(text_col: str, body) -> Column:
    """``body(text, words)`` with the words split once; a null text counts as empty."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return let(word_list(text), lambda words: body(text, words))


def with_at_hand(text: Column, words: Column, at_hand: Sequence[str], body) -> Column:
    """``body(features)`` with the statistics of ``at_hand`` computed once, the others where they are read."""
    own = features(text, words)
    if not at_hand:
        return body(own)
    return let(F.struct(*[own[n].alias(n) for n in at_hand]), lambda k: body(own | {n: k[n] for n in at_hand}))


def by_rejections_per_cost(names: Sequence[str], standing: dict[int, int], cost: dict[str, float]) -> list[str]:
    """Rules by rejections per cost, each counted among the rows that those before
    let pass. ``standing``: rows by the set of rules that they fail, as a bit mask."""
    left, out = dict(enumerate(names)), []
    while left:
        best = max(left, key=lambda i: (sum(n for m, n in standing.items() if m >> i & 1) / cost[left[i]], -cost[left[i]]))
        standing = {m: n for m, n in standing.items() if not m >> best & 1}
        out.append(left.pop(best))
    return out


def ordered(sample: DataFrame, text_col: str = "text", at_hand: Sequence[str] = (),
            given: Callable[[dict[str, Column]], list[Rule]] = rules) -> list[str]:
    """Names of the rules by rejections per cost on the sample."""
    names = [r.name for r in given(features(F.lit(""), F.array(F.lit(""))))]
    on = lambda pick: on_text(text_col, lambda t, w: with_at_hand(t, w, at_hand, lambda f: pick(f, w)))
    failing = {n: on(lambda f, _, i=i: given(f)[i].fails) for i, n in enumerate(names)}
    mask = sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(failing.values())), F.lit(0))
    standing = {r[0]: r[1] for r in sample.groupBy(mask.alias("mask")).agg(F.count("*")).collect()}

    def seconds(x: Column) -> float:
        job, took = sample.agg(F.count_if(x)), []
        for _ in range(TIMINGS + 1):  # the first compiles
            began = time.perf_counter()
            job.collect()
            took.append(time.perf_counter() - began)
        return statistics.median(took[1:])

    # what every rule shares: the words, and the statistics at hand
    shared = seconds(on(lambda f, w: (F.size(w) >= 0) & F.concat(*[f[n].cast("string") for n in at_hand], F.lit("")).isNotNull()))
    cost = {n: max(1e-4, seconds(x) - shared) for n, x in failing.items()}
    return by_rejections_per_cost(names, standing, cost)


def sampled(df: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` rows, drawn evenly and stored."""
    n = df.count()
    return stored(df.sample(fraction=min(1.0, rows / n), seed=17) if n else df, "sample")


def first_failed(given: list[Rule], order: list[str]) -> Column:
    """Name of the first rule in order that fails, null if none; later rules are not computed."""
    by_name, out = {r.name: r for r in given}, F.lit(None).cast("string")
    for name in reversed(order):
        out = F.when(by_name[name].fails, F.lit(name)).otherwise(out)
    return out


def computed_once(df: DataFrame, keep: list[str], value: Column) -> DataFrame:
    """``keep`` and the fields of a struct. The one-row generator keeps later
    filters above it, which would else compute the struct once for every use."""
    return df.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(value)))


def kept_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, with their own columns. Statistics are
    computed inside the cascade, so a rejected row skips those it does not need."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    order = ordered(sampled(df.select("text")))
    verdict = on_text("text", lambda t, w: F.struct(first_failed(rules(features(t, w)), order).alias("failed")))
    return computed_once(df, ["row"], verdict).filter("failed is null").select("row.*")


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, the statistics of RETURNED, base_failed, and
    kept: false if base_failed, else the verdict of the cascade over the other rules."""
    df = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    order = ordered(sampled(df.select("text")), at_hand=RETURNED)

    def judged(f: dict[str, Column]) -> Column:
        base = base_rules(f)
        failed = base[0].fails | base[1].fails
        others = [n for n in order if n not in {r.name for r in base}]
        kept = F.when(failed, False).otherwise(first_failed(rules(f), others).isNull())
        return F.struct(*[f[n].alias(n) for n in RETURNED], failed.alias("base_failed"), kept.alias("kept"))

    return computed_once(df, ["doc_id"], on_text("text", lambda t, w: with_at_hand(t, w, RETURNED, judged)))
