"""Quality rules: a table of thresholds compiled into one projection of Spark's own functions.

A rule bounds the ratio of two measures of a text (or one measure): ``Rule("symbols", "n_symbols", "n_words", most=0.1)``
fails where ``n_symbols > 0.1 * n_words``.  ``assess`` measures a text once, in plain expressions over the row's own arrays
of words and lines, and evaluates the whole table beside them: no user function, no shuffle, no second scan.

Words are ``[^\\x20\\x09-\\x0D]+``, lines are split at ``\\n`` and count if they hold a word.  A null or empty text has no
words and every measure is 0; rules on shares of nothing then hold, those that ask for a least count fail.  Rows, repeated
ones too, are kept one for one; result names replace columns of the same name.  The memory of a row is a few times that
of its text: a text of 2 MB takes some 100 MB in a task.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of the languages of the corpus.
STOP_WORDS = (
    "the of and to in is that it for was with as on be this are have from or an a at by not "
    "der die das und ist ein eine zu den dem von mit sich nicht auf im als für es "
    "le la les de des du et un une que est dans pour en qui sur pas au par plus "
    "el los las del y una por con para su se no lo como más pero"
).split()


class Rule(NamedTuple):
    """``least * per <= measure <= most * per`` must hold; an open bound is None, ``per`` None stands for 1."""

    name: str
    measure: str
    per: str | None = None
    least: float | None = None
    most: float | None = None


#: The table of the registered query.
RULES = (
    Rule("few_words", "n_words", least=50),
    Rule("many_words", "n_words", most=1_000_000),
    Rule("short_words", "word_chars", "n_words", least=2.5),
    Rule("long_words", "word_chars", "n_words", most=15),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("letters", "n_letters", "word_chars", least=0.7),
    Rule("shouting", "n_upper_words", "n_words", most=0.5),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=0.3),
    Rule("repeated_words", "n_repeat_words", "n_words", most=0.5),
)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names with underscores added until no column has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def _measures(text: Column, words: Column, lines: Column, grams: Column) -> dict[str, Column]:
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    without = lambda chars: F.length(F.translate(text, chars, ""))
    # neighbours in the sorted array with the same three words are occurrences of one window
    same = lambda a, b: (a["h"] == b["h"]) & (a["x"] == b["x"]) & (a["y"] == b["y"]) & (a["z"] == b["z"])
    covered = F.zip_with(grams, F.slice(grams, 2, F.greatest(F.size(grams), F.lit(1))), lambda a, b: F.when(
        same(a, b), F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2)))
    return {
        "n_words": count(F.size(words)),
        "word_chars": count(without(WHITE)),
        "n_symbols": count(F.length(text) - without(SYMBOLS)),
        "n_letters": count(F.length(F.regexp_replace(text, r"[^\p{L}\p{M}]+", ""))),
        "n_upper_words": count(F.size(F.filter(words, lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 1)))),
        "n_stop_words": count(F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS)))),
        "n_lines": count(F.size(lines)),
        "n_dup_lines": count(F.size(lines) - F.size(F.array_distinct(lines))),
        "n_bullet_lines": count(F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09]*[-*•‣●▪◦·]")))),
        "n_ellipsis_lines": count(F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))),
        "n_repeat_words": count(F.size(F.array_distinct(F.flatten(F.filter(covered, lambda x: x.isNotNull()))))),
    }


MEASURES = ("n_words", "word_chars", "n_symbols", "n_letters", "n_upper_words", "n_stop_words", "n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines", "n_repeat_words")


def compile_rules(rules: Iterable[Rule]) -> Column:
    """The array of the names of the rules that the measures of a row break, in the table's order."""
    broken = []
    for r in rules:
        per = F.lit(1.0) if r.per is None else F.col(r.per)
        out = [F.col(r.measure) < F.lit(float(r.least)) * per] if r.least is not None else []
        out += [F.col(r.measure) > F.lit(float(r.most)) * per] if r.most is not None else []
        for test in out:
            broken.append(F.when(test, F.lit(r.name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measures of each text (``MEASURES``, long)."""
    kept = df.drop(*(m for m in MEASURES if m != text))
    t, words, lines, windows, grams = fresh(kept, "text_", "words_", "lines_", "windows_", "grams_")
    one = kept.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    one = one.withColumns({
        words: F.regexp_extract_all(F.col(t), F.lit(WORD), F.lit(0)),
        lines: F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)),
    })
    n = F.size(words)
    # windows of three words; only if a hash occurs twice are they ordered, by hash and then by the words themselves
    one = one.withColumn(windows, F.transform(
        F.filter(F.arrays_zip(F.col(words).alias("x"), F.slice(words, 2, F.greatest(n, F.lit(1))).alias("y"), F.slice(words, 3, F.greatest(n, F.lit(1))).alias("z")), lambda w: w["z"].isNotNull()),
        lambda w, i: F.struct(F.xxhash64(w["x"], w["y"], w["z"]).alias("h"), w["x"].alias("x"), w["y"].alias("y"), w["z"].alias("z"), i.alias("i")),
    ))
    repeats = F.size(F.array_distinct(F.col(windows)["h"])) < F.size(windows)
    one = one.withColumn(grams, F.when(repeats, F.sort_array(windows)).otherwise(F.slice(windows, 1, 0)))
    found = _measures(F.col(t), F.col(words), F.col(lines), F.col(grams))
    return one.select(*kept.columns, *(found[m].alias(m) for m in MEASURES))


def assess(df: DataFrame, rules: Iterable[Rule] = RULES, text: str = "text", failed: str = "failed", kept: str = "kept") -> DataFrame:
    """``df`` with the measures, the names of the broken rules and whether none is broken."""
    out = measure(df.drop(failed, kept), text)
    broken = compile_rules(rules)
    return out.withColumn(failed, broken).withColumn(kept, F.size(failed) == 0)
