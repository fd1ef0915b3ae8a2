"""Quality rules: a threshold table compiled into one projection of ratios."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerline.llm.common import let, window_hashes, words
from peerline.operators.rows import fresh_name

WINDOW = 8
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, Spanish and German, and how a table names these languages.
LANGUAGES = ("en", "fr", "es", "de")
STOP_WORDS = (
    "a an and are as at be by for from in is it not of on or that the this to was were with "
    "au avec ce dans de des du elle en est et il la le les ne pas pour que qui sur un une "
    "como con del el es las los no o para por se su sus una y "
    "auf das dem den der die ein eine ist mit nicht sich sie und von zu"
).split()


@dataclass(frozen=True)
class Rule:
    """A ratio of two measures must lie in [low, high]; texts under `least_words` words are not held to it, nor texts in other languages than `languages` if given."""

    name: str
    part: str
    whole: str | None
    low: float | None = None
    high: float | None = None
    least_words: int = 0
    languages: tuple[str, ...] = ()


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("words", "n_words", None, 20),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("shouts", "n_shouts", "n_words", None, 0.2),
    Rule("stop_words", "n_stop_words", "n_words", 0.04, None, 40, LANGUAGES),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.4),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.3),
)


def _length(text: Column) -> Column:
    return F.char_length(text).cast("long")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def repeat_words(ws: Column, size: int = WINDOW) -> Column:
    """Words that lie in a window of `size` words found twice or more in the text.

    Windows are compared by a 64-bit hash that is chained word by word. Texts without
    an equal pair stop at the distinct count; the others sort (hash, start).
    """
    # The words are bound: a filter on the verdict is pushed below the projection that splits them.
    hashes = let(ws, lambda w: F.when(F.size(w) >= size, window_hashes(w, size)).otherwise(F.array().cast("array<bigint>")))

    def covered(h: Column) -> Column:
        def of(s: Column) -> Column:
            again = F.transform(
                s,
                lambda e, k: F.when(
                    (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"]), e["i"]
                ),
            )
            return let(
                F.sort_array(F.filter(again, lambda i: i.isNotNull())),
                lambda p: F.aggregate(
                    F.transform(p, lambda i, k: F.coalesce(F.least(F.lit(size), i - F.get(p, k - 1)), F.lit(size))),
                    F.lit(0),
                    lambda total, x: total + x,
                ),
            )

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), of)

    return let(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
    ).cast("long")


def measures(text: Column, ws: Column) -> dict[str, Column]:
    """Every measure the rules speak of, for a text (not null) and its words."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    return {
        "n_words": F.size(ws).cast("long"),
        "word_chars": _length(_without(text, " \t\n\x0b\x0c\r")),
        "n_symbols": _length(text) - _length(_without(text, SYMBOLS)),
        "n_shouts": _length(text) - _length(_without(text, "!")),
        "n_stop_words": F.size(
            F.filter(ws, lambda w: F.lower(F.btrim(w, F.lit(".,;:!?"))).isin(STOP_WORDS))
        ).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(ws),
    }


def failed(rule: Rule, measure: Callable[[str], Column] = F.col, lang: Column | None = None) -> Column:
    """Whether a row breaks the rule; a ratio over nothing breaks no rule. A text of no stated language is held to the lists of all."""
    whole = F.lit(1) if rule.whole is None else measure(rule.whole)
    part, broken = measure(rule.part), F.lit(False)
    if rule.low is not None:
        broken = broken | (part < F.lit(rule.low) * whole)
    if rule.high is not None:
        broken = broken | (part > F.lit(rule.high) * whole)
    if rule.languages and lang is not None:
        broken = broken & F.coalesce(F.lower(lang).isin(*rule.languages), F.lit(True))
    return broken & (measure("n_words") >= rule.least_words)


def base_failed(measure: Callable[[str], Column] = F.col) -> Column:
    """Whether a row has too few words or too many repeated ones."""
    return (measure("n_words") < 20) | (100 * measure("n_repeat_words") > 30 * measure("n_words"))


def passes(text: Column, rules: tuple[Rule, ...] = RULES, lang: Column | None = None) -> Column:
    """Whether a text passes, as one condition that binds the words and every measure.

    A filter gets its condition with all columns written out, so what several rules speak of would be measured again for each.
    """

    def judged(m: Column) -> Column:
        broken = base_failed(m.getField)
        for rule in rules:
            broken = broken | failed(rule, m.getField, lang)
        return ~broken

    def measured(t: Column) -> Column:
        return let(words(t), lambda ws: let(F.struct(*[x.alias(n) for n, x in measures(t, ws).items()]), judged))

    return let(F.coalesce(text, F.lit("")), measured)


def assess(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Add every measure, `failed_rules`, `base_failed` and `kept` to `docs`.

    All of it is one row-wise projection without user functions and without a shuffle.
    A null or empty text has no words and fails. Repeated rows are judged alike. A column `lang`, if there is one, tells which
    texts the stop words fit. Columns of `docs` that carry the name of a measure or verdict give way to the new one; all others stay,
    whatever their names.
    """
    added = [*measures(F.lit(""), F.array()), "failed_rules", "base_failed", "kept"]
    free = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    body = F.coalesce(F.col(text), F.lit(""))
    whole, cut = fresh_name("whole_text", docs), fresh_name("cut_words", docs)
    measured = free.withColumn(whole, body).withColumn(cut, words(F.col(whole)))
    measured = measured.withColumns(measures(F.col(whole), F.col(cut))).drop(whole, cut)
    lang = F.col("lang") if "lang" in free.columns else None
    verdicts = F.array(*[F.when(failed(r, lang=lang), F.lit(r.name)) for r in rules])
    return measured.withColumns(
        {"failed_rules": F.filter(verdicts, lambda r: r.isNotNull()), "base_failed": base_failed()}
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with the columns they came with; nulls, repeated rows and languages as in `assess`."""
    return docs.filter(passes(F.col("text"), rules, F.col("lang") if "lang" in docs.columns else None))
