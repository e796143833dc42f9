"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document.  The ledger keeps one bit per failed rule and
the numbers the rules looked at, so a policy (a version and the rules it enforces) is one
bitwise test, and an ablation is an aggregation of bits: no text is read again.

Only DataFrame expressions are used.  Windows of five words are compared by a 64-bit hash
of their words' hashes; within one text of ``n`` words two different windows share one with
a probability below ``n * n / 2**65``.

Defined results: a null or empty text has no words, measures 0 everywhere and fails ``few_words``;
ids may be null or repeat, every row is measured by itself; other columns are ignored or,
in ``apply_policy``, carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, plain_words

WINDOW = 5
MIN_WORDS = 10
REPEATED_PERCENT = 20
SYMBOLS_PERCENT = 10
DUPLICATE_LINES_PERCENT = 30
CAPITALS_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
CAPITALS = "\\p{Lu}"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")

#: Rule name -> true where a document fails it; the place in this table is the rule's bit, so only append.
RULES: dict[str, Callable[[], Column]] = {
    "few_words": lambda: F.col("n_words") < MIN_WORDS,
    "repeated_words": lambda: 100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"),
    "symbols": lambda: 100 * F.col("n_symbols") > SYMBOLS_PERCENT * F.col("n_words"),
    "duplicate_lines": lambda: 100 * F.col("n_dup_lines") > DUPLICATE_LINES_PERCENT * F.col("n_lines"),
    "capitals": lambda: 100 * F.col("n_capitals") > CAPITALS_PERCENT * F.col("word_chars"),
}

#: Version -> rules it enforces.  A published version never changes.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "duplicate_lines", "capitals"),
}
CURRENT = "v2"


def mask_of(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(windows: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""

    def repeated(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))

    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    starts = F.sort_array(F.transform(_let(by_hash, repeated), lambda x: x["i"]))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def add(acc: Column, i: Column) -> Column:
        return F.struct(
            (i + WINDOW).alias("end"), (acc["total"] + i + WINDOW - F.greatest(acc["end"], i)).alias("total")
        )

    return F.aggregate(starts, zero, add, lambda acc: acc["total"])


def measure(rows: DataFrame, text: str = "__text") -> DataFrame:
    """Replace the text by the numbers of ``MEASURES``.  Each step uses what the one before computed once."""
    keep = [c for c in rows.columns if c != text]
    words, hashes, windows = F.col("__words"), F.col("__hashes"), F.col("__windows")
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    # A text splits into one piece more than it has separators.
    count = lambda chars: F.size(F.split(F.coalesce(F.col(text), F.lit("")), chars)) - 1
    first = rows.select(
        *keep,
        count(SYMBOLS).alias("n_symbols"),
        count(CAPITALS).alias("n_capitals"),
        lines.alias("__lines"),
        plain_words(F.col(text)).alias("__words"),
    )
    second = first.select(
        *keep,
        "n_symbols",
        "n_capitals",
        F.size("__lines").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).alias("n_dup_lines"),
        F.size(words).alias("n_words"),
        F.char_length(F.array_join(words, "")).alias("word_chars"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("__hashes"),
    )
    starts = F.sequence(F.lit(0), F.col("n_words") - WINDOW)
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    third = second.withColumn(
        "__windows", F.when(F.col("n_words") >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>"))
    ).drop("__hashes")
    some = F.size(F.array_distinct(windows)) < F.size(windows)
    fourth = third.withColumn("n_repeat_words", F.when(some, _covered(windows)).otherwise(F.lit(0)))
    # A filter on the numbers must not be moved below this and compute them anew: it cannot pass a generator.
    numbers = F.struct(*[F.col(m).cast("bigint").alias(m) for m in MEASURES])
    return fourth.select(*keep, F.explode(F.array(numbers)).alias("__numbers")).select(*keep, "__numbers.*")


def add_failures(measured: DataFrame) -> DataFrame:
    """The bits of all rules, each rule evaluated once."""
    bits = [F.when(fails(), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint") for k, fails in enumerate(RULES.values())]
    return measured.withColumn("failures", reduce(lambda a, b: a.bitwiseOR(b), bits))


def quality_ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, the measurements and the failure bits."""
    return add_failures(measure(docs.select(F.col(key), F.col(text).alias("__text"))))


def passes(policy: str = CURRENT) -> Column:
    """True where a ledger row breaks no rule of the policy."""
    return F.col("failures").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def apply_policy(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The documents, all columns, that the policy accepts."""
    ledger = add_failures(measure(packed(docs, __text=F.col(text))))
    return ledger.where(passes(policy)).select("__row.*")


def ablations(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that only it rejects, and all the policy rejects.

    The bits are counted first: at most one row per combination of rules is left.
    """
    mask = F.lit(mask_of(POLICIES[policy])).cast("bigint")
    combos = ledger.groupBy(F.col("failures").bitwiseAND(mask).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask_of((r,))).cast("bigint").alias("bit")) for r in POLICIES[policy]]))
    each = combos.select("bits", "n", rules.alias("r")).select("bits", "n", "r.*")
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("only_this"),
        F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("rejected"),
    )


def any_failed(*rules: str) -> Column:
    """True where a ledger row fails any of the rules."""
    bits = [F.col("failures").bitwiseAND(F.lit(mask_of((r,)))) != 0 for r in rules]
    return reduce(or_, bits)
