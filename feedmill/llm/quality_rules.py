"""Quality rules: a table of thresholds, compiled into one projection of built-in functions.

Base figures: words, their characters, symbols, repeated lines, words in repeated 5-word windows. The rules are rows of
``RULES``: a ratio, a lower and an upper bound (None: open) and the number of words from which on it is judged. A
document is kept if it passes the base rules and every ratio lies within its bounds.

Cases: null, empty and blank texts have no words, fail the base rules and are not kept; very long texts are judged
whole; repeated rows give repeated results; an empty table an empty one. Columns of other names are not read, and the
operator's own columns carry names that cannot clash, as only id and text are taken over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE, WORD, text_of

#: Frequent function words of the corpus languages.
STOP_WORDS = (
    "the of and to in a is that it for was on with as be by at this from or an are "
    "der die das und in zu den ist nicht von mit dem ein eine auf für als auch sich im "
    "le la les de des et un une en que est pour dans qui sur au ne pas ce il par "
    "el los las y del que se no por con una para su es lo como más o pero al"
).split()


@dataclass(frozen=True)
class Rule:
    name: str
    low: float | None
    high: float | None
    from_words: int = 0


RULES = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbols_per_word", None, 0.3),
    Rule("stop_word_ratio", 0.02, None, 50),
    Rule("duplicate_line_ratio", None, 0.5),
    Rule("capital_ratio", None, 0.6),
    Rule("exclamations_per_word", None, 0.3),
)


def base_figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per document; no function of more than one row, so no shuffle."""
    text = text_of(text_col)
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"), F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)).alias("w"))
    hashes = "CASE WHEN size(w) >= 6 THEN transform(sequence(0, size(w) - 5), i -> xxhash64(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4])) ELSE array() END"
    df = df.withColumn("h", F.expr(f"cast({hashes} AS array<bigint>)"))
    df = df.withColumn("many", F.expr("size(array_distinct(h)) < size(h)"))
    # Sorted (hash, place): a window is repeated if a neighbour has its hash.
    df = df.withColumn("s", F.expr("CASE WHEN many THEN array_sort(transform(h, (x, i) -> struct(x AS x, i AS i))) END"))
    df = df.withColumn(
        "p",
        F.expr(
            "CASE WHEN many THEN array_sort(transform(filter(s, (z, k) -> coalesce(get(s, k - 1).x = z.x, false) "
            "OR coalesce(get(s, k + 1).x = z.x, false)), z -> z.i)) END"
        ),
    )
    repeated = (
        "CASE WHEN many AND size(p) > 0 THEN 5 + aggregate(zip_with(slice(p, 1, size(p) - 1), slice(p, 2, size(p) - 1), (a, b) -> least(5, b - a)), 0L, (n, x) -> n + x) ELSE 0L END"
    )
    # Not as SQL text, whose string literals would lose the pattern's backslashes.
    lines = F.filter(F.split("t", "\n", -1), lambda line: line.rlike(WORD))
    return df.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE + "+", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("l"),
        F.expr(repeated).cast("long").alias("n_repeat_words"),
        F.expr(f"size(filter(w, x -> array_contains(array({', '.join(repr(x) for x in dict.fromkeys(STOP_WORDS))}), lower(x))))").alias("stop_words"),
        F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).alias("capitals"),
        F.length(F.regexp_replace("t", r"[^\p{L}]+", "")).alias("letters"),
        (F.length("t") - F.length(F.translate("t", "!", ""))).alias("exclamations"),
    ).select(
        "*", F.size("l").alias("word_lines"), (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines")
    ).drop("l")


def _ratios() -> dict[str, Column]:
    def over(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "mean_word_chars": over("word_chars", "n_words"),
        "symbols_per_word": over("n_symbols", "n_words"),
        "stop_word_ratio": over("stop_words", "n_words"),
        "duplicate_line_ratio": over("n_dup_lines", "word_lines"),
        "capital_ratio": over("capitals", "letters"),
        "exclamations_per_word": over("exclamations", "n_words"),
    }


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules as one boolean column."""
    ratios, verdict = _ratios(), F.lit(True)
    for rule in rules:
        value, ok = ratios[rule.name], F.lit(True)
        if rule.low is not None:
            ok = ok & (value >= rule.low)
        if rule.high is not None:
            ok = ok & (value <= rule.high)
        verdict = verdict & ((F.col("n_words") < rule.from_words) | ok)
    return verdict


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base figures, ratios and the verdict of every document."""
    df = base_figures(docs, id_col, text_col)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & compiled(rules)).alias("kept"),
        *[c.alias(n) for n, c in _ratios().items()],
    )
