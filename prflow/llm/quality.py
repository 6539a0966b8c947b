"""Quality rules: a threshold table compiled into one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prflow.llm.common import let, words

# Frequent function words of the covered languages.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "a", "that", "for", "it", "was", "on", "with", "as", "by", "this", "are", "be", "at", "or", "from"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch", "es", "an", "er", "so"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "plus", "pas", "au", "sur", "avec", "elle", "il"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "lo", "como"],
}

# (rule, measure, lowest allowed, highest allowed); None leaves a side open.
# A measure without a value (no words, no lines) breaks no rule.
RULES = [
    ("too_short", "n_words", 50, None),
    ("repeated", "repeat_share", None, 0.5),
    ("word_length", "mean_word_length", 2.0, 15.0),
    ("symbols", "symbol_share", None, 0.1),
    ("stop_words", "stop_words", 2, None),
    ("duplicate_lines", "dup_line_share", None, 0.5),
    ("capitals", "upper_share", None, 0.5),
]
BASE = ("too_short", "repeated")


def _repeat_words(found: Column) -> Column:
    """Words inside 3-word windows that occur at least twice. Windows are
    sorted with their place, so equal ones are neighbours; the work is
    n log n in the words of a text, and nothing for texts without repeats."""
    windows = let(
        found,
        lambda w: F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.concat_ws(" ", x, w[i + 1], w[i + 2]),
        ),
    )

    def starts(win: Column) -> Column:
        placed = F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        repeated = let(
            placed,
            lambda s: F.filter(
                F.transform(
                    s,
                    lambda e, i: F.when(
                        (F.get(s, i - 1)["x"] == e["x"]) | (F.get(s, i + 1)["x"] == e["x"]), e["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            ),
        )
        return F.sort_array(repeated)

    def covered(s: Column) -> Column:
        gaps = F.transform(s, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(s, i + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    return let(
        windows,
        lambda win: F.when(
            F.size(F.array_distinct(win)) < F.size(win), let(starts(win), covered)
        ).otherwise(0),
    ).cast("long")


def measure(text: Column) -> Column:
    """A struct with all counts and ratios of a text."""
    body = F.coalesce(text, F.lit(""))
    stop = [w for lang in sorted(STOP_WORDS) for w in STOP_WORDS[lang]]

    def counted(w: Column) -> Column:
        # one row value that holds the words once for all word measures
        joined = F.array_join(w, "")
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(joined).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*sorted(set(stop))))).alias("stop_words"),
        )

    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_line = let(
        lines,
        lambda x: F.struct(
            F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")
        ),
    )
    symbols = (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long")
    letters = F.length(F.regexp_replace(body, r"[^\p{L}]+", ""))
    upper = F.length(F.regexp_replace(body, r"[^\p{Lu}]+", ""))
    raw = F.struct(
        let(words(body), counted).alias("w"), by_line.alias("l"),
        symbols.alias("n_symbols"), letters.alias("letters"), upper.alias("upper"),
    )

    def ratios(r: Column) -> Column:
        w, line = r["w"], r["l"]
        return F.struct(
            w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"),
            r["n_symbols"].alias("n_symbols"), line["dup"].alias("n_dup_lines"),
            w["n_repeat_words"].alias("n_repeat_words"), w["stop_words"].alias("stop_words"),
            F.try_divide(w["word_chars"], w["n_words"]).alias("mean_word_length"),
            F.try_divide(r["n_symbols"], w["word_chars"]).alias("symbol_share"),
            F.try_divide(w["n_repeat_words"], w["n_words"]).alias("repeat_share"),
            F.try_divide(line["dup"], line["n"]).alias("dup_line_share"),
            F.try_divide(r["upper"], r["letters"]).alias("upper_share"),
        )

    return let(raw, ratios)


def judge(m: Column, rules=RULES) -> Column:
    """Names of the broken rules, from the threshold table."""

    def broken(measure: str, low, high) -> Column:
        sides = []
        if low is not None:
            sides.append(m[measure] < F.lit(low))
        if high is not None:
            sides.append(m[measure] > F.lit(high))
        out = sides[0]
        for side in sides[1:]:
            out = out | side
        return F.coalesce(out, F.lit(False))

    named = [F.when(broken(*rule[1:]), F.lit(rule[0])) for rule in rules]
    return F.array_compact(F.array(*named))


def quality(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Every row with ``measures`` (struct of counts and ratios), ``broken``
    (the rules it breaks), ``base_failed`` and ``kept``.

    One projection of built-in functions: no shuffle, so no key can be hot.
    Null and empty texts have no words and fail ``too_short``. Repeated rows
    and ties are judged each on its own. An empty table gives an empty result.
    Input columns with these four names are replaced.
    """
    source = docs.drop("measures", "broken", "base_failed", "kept")
    found = let(measure(F.col(text)), lambda m: F.struct(m.alias("m"), judge(m, rules).alias("b")))
    judged = source.select("*", found.alias("measures")).select(
        *[F.col(f"`{c}`") for c in source.columns],
        F.col("measures.m").alias("measures"), F.col("measures.b").alias("broken"),
    )
    base = F.arrays_overlap("broken", F.array(*map(F.lit, BASE)))
    return judged.select("*", base.alias("base_failed"), (F.size("broken") == 0).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The documents that break no rule, with their own columns untouched."""
    return docs.filter(F.size(let(measure(F.col(text)), lambda m: judge(m, rules))) == 0)
