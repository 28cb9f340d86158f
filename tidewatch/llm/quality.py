"""Line-first quality rules: each line of a text is judged by its punctuation, by navigation signs and by
boilerplate phrases; failing and repeated lines go, and a document that loses too much goes as a whole.
Everything is a Spark SQL expression over one row, so nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import SPACE, SPACE_CHARS, WORD, bind, literal

SYMBOLS = "#*$%&|<>"
BOILERPLATE = (
    "accept cookies|all rights reserved|back to top|click here|cookie policy|enable javascript|forgot password|"
    "log in|lorem ipsum|newsletter|privacy policy|read more|share this|sign in|sign up|skip to content|terms of service|terms of use"
)


#: Columns that `measure` adds.
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept_text", "kept",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules. A line of a few words needs no full stop; a long one may name a policy."""

    symbols_per_word: float = 0.1
    upper_share: float = 0.5
    unpunctuated_words: int = 4
    boilerplate_words: int = 20
    max_loss: float = 0.5


def _repeat_words() -> str:
    """Words inside 5-word windows that occur at least twice, from `windows`, the array of window hashes.

    Pairs (hash, place) are sorted; a window whose neighbour has its hash is repeated; the places of
    such windows, sorted, cover min(5, distance to the one before) new words each.
    """
    twice = "filter(p, (x, j) -> x.h = get(p, j - 1).h OR x.h = get(p, j + 1).h)"
    places = bind("sort_array(transform(windows, (h, i) -> struct(h AS h, i AS i)))", "p", f"sort_array(transform({twice}, x -> x.i))")
    covered = (
        f"aggregate({places}, named_struct('n', 0L, 'last', -5), "
        "(a, i) -> named_struct('n', a.n + least(5, i - a.last), 'last', i), a -> a.n)"
    )
    return f"CASE WHEN size(windows) = size(array_distinct(windows)) THEN 0L ELSE {covered} END"


def measure(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Add the counts, `base_failed`, `kept` and `kept_text` to every document.

    A null text counts as empty: no words, base failed, kept_text empty. Lines without a word are
    neither judged nor counted and do not stay; equal lines stay once. A document is kept if the base
    rules pass and at most `max_loss` of the characters of its lines with words is lost. Repeated
    documents are judged alike and all stay in the result. Columns of `docs` that have the name of an
    added one are replaced.
    """
    blank = f"btrim(coalesce(text, ''), {SPACE_CHARS})"
    words = f"CASE WHEN {blank} = '' THEN CAST(array() AS ARRAY<STRING>) ELSE split({blank}, {literal(SPACE + '+')}) END"
    window = f"xxhash64({', '.join(f'_words[i + {k}]' for k in range(5))})"
    gone = lambda text, chars: f"(length({text}) - length(translate({text}, {chars}, '')))"
    count = f"size(split(btrim(l, {SPACE_CHARS}), {literal(SPACE + '+')}))"
    letters = r"length(regexp_replace(l, '[^\\p{L}]', ''))"
    upper = r"length(regexp_replace(l, '[^\\p{Lu}]', ''))"
    passes = " AND ".join(
        (
            f"{gone('l', literal(SYMBOLS))} <= {rules.symbols_per_word} * n",
            f"(n > {rules.unpunctuated_words} OR l RLIKE {literal('[.!?:;…”’»\"\')]' + SPACE + '*$')})",
            f"{upper} <= greatest({rules.upper_share} * {letters}, 1)",
            f"(n > {rules.boilerplate_words} OR NOT lower(l) RLIKE {literal(BOILERPLATE)})",
        )
    )
    judged = "filter(_lines, l -> " + bind(count, "n", passes) + ")"
    found = (
        docs.withColumn("_words", F.expr(words))
        .withColumn("_lines", F.expr(f"filter(split(coalesce(text, ''), '\\n'), l -> l RLIKE {literal(WORD)})"))
        .withColumn("windows", F.expr(f"CASE WHEN size(_words) >= 5 THEN transform(sequence(0, size(_words) - 5), i -> {window}) ELSE CAST(array() AS ARRAY<BIGINT>) END"))
        .withColumn("n_words", F.expr("CAST(size(_words) AS BIGINT)"))
        .withColumn("word_chars", F.expr(f"CAST(length(translate(coalesce(text, ''), {SPACE_CHARS}, '')) AS BIGINT)"))
        .withColumn("n_symbols", F.expr(f"CAST(coalesce({gone('text', literal(SYMBOLS))}, 0) AS BIGINT)"))
        .withColumn("n_dup_lines", F.expr("CAST(size(_lines) - size(array_distinct(_lines)) AS BIGINT)"))
        .withColumn("n_repeat_words", F.expr(_repeat_words()))
        .drop("_words", "windows")
        .withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))
        .withColumn("kept_text", F.expr(f"array_join(array_distinct({judged}), '\\n')"))
        .withColumn("kept", F.expr(f"NOT base_failed AND length(kept_text) >= (1 - {rules.max_loss}) * length(array_join(_lines, '\\n'))"))
        .drop("_lines")
    )
    # A generated row is a column of its own, so a filter on `kept` is not computed once more below.
    rest = [name for name in found.columns if name not in MEASURES]
    return found.select(*rest, F.explode_outer(F.array(F.struct(*MEASURES))).alias("_measures")).select(*rest, "_measures.*")


def clean(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Kept documents with their failing lines removed, in the columns of `docs` whatever their names."""
    kept = measure(docs.select(F.struct("*").alias("_row"), "text"), rules).where("kept")
    new = {"text": F.col("kept_text"), "n_chars": F.expr("CAST(length(kept_text) AS BIGINT)")}
    return kept.select(*(new.get(name, F.col("_row")[name]).alias(name) for name in docs.columns))
