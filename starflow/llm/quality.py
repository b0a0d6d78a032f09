"""Quality rules: a threshold table compiled into one Spark projection.

Each rule compares 100 times a count with a percentage of another count, so every
verdict is integer arithmetic and repeats exactly in SQL. The whole text is read and
no user function runs.

Defined cases: null and empty texts have no words and fail the base; rows are judged
one by one, so repeated rows and ties need no choice; an empty table gives no rows;
further columns of the input are ignored by ``measure`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.text import let, words

# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = tuple(
    "the of and to in is that for it as was with be by on not at are this or an "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als "
    "de la le et les en un une que est pour qui dans par sur pas du "
    "el los se las con una su al lo".split()
)
STOP_FORMS = tuple(dict.fromkeys(f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())))


@dataclass(frozen=True)
class Rule:
    """Kept while ``least`` <= 100 * count / base <= ``most``; an open end is None."""

    name: str
    count: str
    base: str
    least: int | None = None
    most: int | None = None

    def passes(self) -> Column:
        count, base = F.col(self.count) * 100, F.col(self.base)
        tests = []
        if self.least is not None:
            tests.append(count >= self.least * base)
        if self.most is not None:
            tests.append(count <= self.most * base)
        return reduce(Column.__and__, tests)


BASE_MIN_WORDS = 50
BASE_MOST_REPEATED = 50
RULES = (
    Rule("mean word length", "word_chars", "n_words", least=200, most=1200),
    Rule("symbols per word", "n_symbols", "n_words", most=25),
    Rule("duplicate lines", "n_dup_lines", "n_lines", most=40),
    Rule("stop words", "n_stop_words", "n_words", least=5),
)


def _repeated_words(found: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text."""
    window_count = F.size(found) - 2
    windows = F.transform(
        F.sequence(F.lit(0), window_count - 1),
        lambda i: F.struct(
            F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)).alias("h"),
            i.alias("p"),
        ),
    )

    def same(a: Column, b: Column) -> Column:
        """Equal hashes, and then the three words compared as well."""
        tests = [a["h"] == b["h"]]
        tests += [F.get(found, a["p"] + j) == F.get(found, b["p"] + j) for j in range(3)]
        return F.coalesce(reduce(Column.__and__, tests), F.lit(False))

    def covered(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda x, k: same(F.get(ordered, k - 1), x) | same(F.get(ordered, k + 1), x),
        )
        at = F.flatten(F.transform(again, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
        return F.size(F.array_distinct(at))

    return F.when(window_count < 2, F.lit(0)).otherwise(let(F.sort_array(windows), covered))


def _counts(found: Column, text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return F.struct(
        F.size(found).cast("long").alias("n_words"),
        F.length(F.array_join(found, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        let(lines, F.size).cast("long").alias("n_lines"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated_words(found).cast("long").alias("n_repeat_words"),
        F.size(F.filter(found, lambda w: w.isin(*STOP_FORMS))).cast("long").alias("n_stop_words"),
    )


def verdicts(rules: Sequence[Rule] = RULES) -> dict[str, Column]:
    """The compiled columns over the counts: one boolean a rule, then the two verdicts."""
    base_failed = (F.col("n_words") < BASE_MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > BASE_MOST_REPEATED * F.col("n_words")
    )
    passed = reduce(Column.__and__, [r.passes() for r in rules], F.lit(True))
    each = {f"passes_{r.name.replace(' ', '_')}": r.passes() for r in rules}
    return each | {"base_failed": base_failed, "kept": ~base_failed & passed}


def measure(
    documents: DataFrame, rules: Sequence[Rule] = RULES, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: counts, each rule's verdict, ``base_failed``, ``kept``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    counted = documents.select(
        F.col(key).alias("doc_id"),
        let(words(whole), lambda found: _counts(found, whole)).alias("c"),
    )
    return counted.select("doc_id", "c.*").withColumns(verdicts(rules))


def keep_good(documents: DataFrame, rules: Sequence[Rule] = RULES, *, text: str = "text") -> DataFrame:
    """The rows that pass, with all their columns. Rows are judged where they lie."""
    whole = F.coalesce(F.col(text), F.lit(""))
    judged = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        let(words(whole), lambda found: _counts(found, whole)).alias("c"),
    )
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")
    flat = judged.select("row", *[F.col(f"c.{n}").alias(n) for n in names])
    return flat.where(verdicts(rules)["kept"]).select("row.*")
