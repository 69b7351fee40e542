"""Line-first cleaning of texts, in built-in column expressions only.

Every line with a word is held against punctuation, navigation and boilerplate rules. Failing lines
are removed; a text that loses more than ``max_loss`` per cent of its words is rejected, and so is one that
fails the base rules (too few words, or most of its words inside repeated three-word windows).

Defined results: a null or blank text has no words and is rejected by the base rule; blank lines are
never removed; every row is judged on its own, so repeated rows get the same verdict; an empty table
gives an empty result. Input columns stay as they are; a column that carries the result's name is
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargauge.llm.common import let, plain, table, words_of

#: Symbols counted by the base statistics.
SYMBOLS = "#*$%&|<>"

#: Phrases that mark a line as site boilerplate (matched in lower case).
BOILERPLATE = (
    # English
    "all rights reserved",
    "accept cookies",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "share this",
    "sign up for",
    "subscribe to our",
    "terms of service",
    "terms of use",
    # German
    "alle rechte vorbehalten",
    "cookies akzeptieren",
    "datenschutzerklärung",
    "hier klicken",
    "jetzt abonnieren",
    "mehr lesen",
    "newsletter abonnieren",
    "nutzungsbedingungen",
    "weiterlesen",
    # French
    "abonnez-vous",
    "accepter les cookies",
    "cliquez ici",
    "lire la suite",
    "mentions légales",
    "partager cet article",
    "politique de confidentialité",
    "tous droits réservés",
    # Spanish
    "aceptar cookies",
    "haga clic aquí",
    "leer más",
    "política de cookies",
    "política de privacidad",
    "suscríbete",
    "todos los derechos reservados",
    "términos y condiciones",
)

HAS_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; shares are per cent of a line's (or a text's) words or characters."""

    min_words: int = 50
    max_repeat_share: int = 50
    max_loss: int = 30
    min_separators: int = 2
    max_separator_share: int = 20
    min_symbols: int = 3
    max_symbol_share: int = 5
    shout_letters: int = 12
    max_exclaimed_share: int = 30
    unpunctuated_words: int = 12
    max_boilerplate_chars: int = 200


def count_of(text: Column, characters: str) -> Column:
    """How often any of ``characters`` occurs."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def count_words(text: Column) -> Column:
    return F.size(words_of(text))


def repeated_words(words: Column) -> Column:
    """How many words lie in a three-word window that the text holds twice or more.

    The windows are sorted with their positions only when some window occurs twice; neighbours in
    that order then tell which positions repeat, without comparing all pairs.
    """

    def marked(ordered: Column) -> Column:
        last = F.size(ordered)

        def twin(item: Column, at: Column) -> Column:
            before = F.when(at > 0, ordered[at - 1]["window"] == item["window"])
            after = F.when(at < last - 1, ordered[at + 1]["window"] == item["window"])
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        covered = F.transform(
            F.filter(ordered, twin), lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)
        )
        return F.size(F.array_distinct(F.flatten(covered)))

    def count(windows: Column) -> Column:
        placed = F.transform(windows, lambda x, i: F.struct(x.alias("window"), i.alias("at")))
        repeats = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(repeats, let(F.sort_array(placed), marked)).otherwise(F.lit(0))

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.concat_ws(" ", w[i], w[i + 1], w[i + 2])
        )

    return let(words, lambda w: F.when(F.size(w) >= 3, let(windows(w), count)).otherwise(F.lit(0)))


def line_fails(line: Column, rules: LineRules) -> Column:
    """True when a line breaks a punctuation, navigation or boilerplate rule; lines without words pass.

    Each rule starts with a test that clean lines fail at once, so the counts behind it are rarely made.
    """
    n_words = count_words(line)
    separators = F.regexp_count(line, F.lit(r"(?:^|[ \t])[|»›·•>/]+(?=[ \t]|$)"))
    navigation = (
        line.rlike(r"[|»›·•>/]")
        & (separators >= rules.min_separators)
        & (separators * 100 > n_words * rules.max_separator_share)
    )
    symbols = count_of(line, "#*$%&<>")
    noisy = (
        line.rlike(r"[#*$%&<>]")
        & (symbols >= rules.min_symbols)
        & (symbols * 100 > F.length(line) * rules.max_symbol_share)
    )
    shouted = ~line.rlike(r"\p{Ll}") & line.rlike(rf"(?:\p{{Lu}}\P{{L}}*){{{rules.shout_letters}}}")
    exclaimed = F.regexp_count(line, F.lit(r"!(?=[ \t\r]|$)"))
    excited = (
        line.contains("!") & (exclaimed >= 2) & (exclaimed * 100 > n_words * rules.max_exclaimed_share)
    )
    unpunctuated = ~line.rlike(r"\p{P}") & (n_words >= rules.unpunctuated_words)
    stock = (F.length(line) <= rules.max_boilerplate_chars) & F.lower(line).rlike("|".join(BOILERPLATE))
    return line.rlike(HAS_WORD) & (navigation | noisy | shouted | excited | unpunctuated | stock)


def line_first(text: Column, rules: LineRules = LineRules()) -> Column:
    """A struct of the base statistics, the cleaned text and the verdict for one text column."""
    content = plain(text)

    def with_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        )

    def with_lines(lines: Column) -> Column:
        judged = F.transform(lines, lambda x: F.struct(x.alias("line"), line_fails(x, rules).alias("fails")))
        worded = F.filter(lines, lambda x: x.rlike(HAS_WORD))
        return F.struct(
            let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            let(judged, split_lines).alias("judged"),
        )

    def split_lines(judged: Column) -> Column:
        bad = F.filter(judged, lambda x: x["fails"])
        return F.struct(
            F.size(bad).cast("long").alias("n_lines_removed"),
            F.aggregate(bad, F.lit(0), lambda n, x: n + count_words(x["line"])).cast("long").alias("n_words_removed"),
            F.array_join(F.filter(judged, lambda x: ~x["fails"])["line"], "\n").alias("clean_text"),
        )

    words, lines = let(words_of(text), with_words), let(F.split(content, "\n", -1), with_lines)
    return let(words, lambda a: let(lines, lambda b: verdict(a, b, count_of(content, SYMBOLS), rules)))


def verdict(words: Column, lines: Column, n_symbols: Column, rules: LineRules) -> Column:
    n_words, lost = words["n_words"], lines["judged"]["n_words_removed"]
    base_failed = (n_words < rules.min_words) | (
        words["n_repeat_words"] * 100 > n_words * rules.max_repeat_share
    )
    return F.struct(
        n_words.alias("n_words"),
        words["word_chars"].alias("word_chars"),
        n_symbols.cast("long").alias("n_symbols"),
        lines["n_dup_lines"].alias("n_dup_lines"),
        words["n_repeat_words"].alias("n_repeat_words"),
        lines["judged"]["n_lines_removed"].alias("n_lines_removed"),
        lost.alias("n_words_removed"),
        lines["judged"]["clean_text"].alias("clean_text"),
        base_failed.alias("base_failed"),
        (~base_failed & (lost * 100 <= n_words * rules.max_loss)).alias("kept"),
    )


def judge_lines(
    docs: DataFrame, text: str = "text", into: str = "line_rules", rules: LineRules = LineRules()
) -> DataFrame:
    """``docs`` with a struct column ``into``: statistics, ``clean_text``, ``base_failed``, ``kept``."""
    return docs.withColumn(into, line_first(F.col(text), rules))


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every document."""
    judged = judge_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[F.col(f"line_rules.{x}").alias(x) for x in fields])


#: The same result in DuckDB: lines and windows are unnested rows here, arrays above.
OP8_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
lines AS (
  SELECT k, unnest(string_split(t, chr(10))) AS line FROM docs),
marked AS (
  SELECT k, line,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n_words,
    length(regexp_replace(line, '[^#*$%&<>]+', '', 'g')) AS symbols,
    len(list_filter(regexp_extract_all(line, '[^\x20\x09]+'), lambda x: regexp_full_match(x, '[|»›·•>/]+'))) AS separators,
    len(regexp_extract_all(line, '!(?:[ \t\r]|$)')) AS exclaimed
  FROM lines),
judged AS (
  SELECT k, line, n_words,
    n_words > 0 AND (
      (separators >= 2 AND separators * 100 > n_words * 20)
      OR (symbols >= 3 AND symbols * 100 > length(line) * 5)
      OR (NOT regexp_matches(line, '\p{Ll}') AND regexp_matches(line, '(?:\p{Lu}\P{L}*){12}'))
      OR (exclaimed >= 2 AND exclaimed * 100 > n_words * 30)
      OR (n_words >= 12 AND NOT regexp_matches(line, '\p{P}'))
      OR (length(line) <= 200 AND regexp_matches(lower(line), '<PHRASES>'))) AS fails
  FROM marked),
per_doc AS (
  SELECT k, sum(n_words)::BIGINT AS n_words,
    coalesce(sum(n_words) FILTER (WHERE fails), 0)::BIGINT AS lost,
    (count(*) FILTER (WHERE n_words > 0) - count(DISTINCT line) FILTER (WHERE n_words > 0))::BIGINT AS n_dup_lines
  FROM judged GROUP BY k),
word_lists AS (SELECT k, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
  SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM word_lists, unnest(range(1, len(w) - 1)) AS r(i)),
repeats AS (SELECT k, i FROM windows QUALIFY count(*) OVER (PARTITION BY k, g) > 1),
covered AS (
  SELECT k, count(DISTINCT p)::BIGINT AS n_repeat_words
  FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM repeats) GROUP BY k),
facts AS (
  SELECT doc_id, n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, lost
  FROM docs JOIN per_doc USING (k) LEFT JOIN covered USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost * 100 <= n_words * 30 AS kept
FROM facts
""".replace("<PHRASES>", "|".join(BOILERPLATE))
