"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much goes with them.

All work is built-in functions over the arrays of a text's lines and words; nothing is exploded or shuffled, so no
group exists that could be large. A text of any length is judged whole.

A null text has no words and no lines. A document with no line left is rejected. Rows with equal or null ids stay
apart, extra columns are passed on, and an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words, the characters that count as symbols, and marks that end a sentence or a part of
# it in the scripts that have any; a line with letters of a script without such marks is not asked for one.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
SENTENCE_MARKS = r"[.!?…:;。｡！？：；।॥۔؟؛։።။។།]"
UNMARKED = r"[ก-๎ກ-ໟ]"
SHOUTED_MARKS = r"[!?]{2,}"
# Phrases of notices and menus, looked for in the lower-cased line.
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under the",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "we use cookies",
    "enable javascript",
    "powered by",
    "lorem ipsum",
    "sign up for our newsletter",
    "click here to",
    "skip to content",
    "tous droits réservés",
    "politique de confidentialité",
    "nous utilisons des cookies",
    "todos los derechos reservados",
    "política de privacidad",
    "utilizamos cookies",
    "alle rechte vorbehalten",
    "datenschutzerklärung",
    "wir verwenden cookies",
)


# Columns that are added.
ADDED = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "lines_failed",
    "clean_text",
    "lost_share",
    "kept",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the verdict on the document."""

    bars_per_word: float = 0.2  # navigation: separators between the entries of a menu
    symbols_per_word: float = 0.3  # punctuation: symbols instead of sentences
    shouts_per_word: float = 0.3  # punctuation: doubled exclamation or question marks
    lost_share: float = 0.3  # share of the characters of all lines whose loss rejects the document


def seen_line(line: Column) -> Column:
    """A line with what several rules ask of it: its words and its lower-cased text."""
    return F.struct(line.alias("line"), F.regexp_count(line, F.lit(WORD)).alias("words"), F.lower(line).alias("lowered"))


def line_verdict(seen: Column, rules: LineRules) -> Column:
    """The first rule that a line fails: navigation, punctuation or boilerplate; NULL if it passes."""
    line, words, lowered = seen["line"], seen["words"], seen["lowered"]
    notice = F.lit(False)
    for phrase in BOILERPLATE:
        notice = notice | lowered.contains(phrase)
    return (
        F.when(F.regexp_count(line, F.lit(r"\|")) >= rules.bars_per_word * words, "navigation")
        .when(F.regexp_count(line, F.lit(SYMBOLS)) >= rules.symbols_per_word * words, "punctuation")
        .when(F.regexp_count(line, F.lit(SHOUTED_MARKS)) >= rules.shouts_per_word * words, "punctuation")
        .when(~line.rlike(f"{SENTENCE_MARKS}|{UNMARKED}"), "punctuation")
        .when(notice, "boilerplate")
    )


def repeated_words(words: Column, windows: Column) -> Column:
    """Words that lie in a 3-word window found twice or more; ``windows`` is the sorted array of them with places."""
    same = lambda a, b: (a["a"] == b["a"]) & (a["b"] == b["b"]) & (a["c"] == b["c"])
    beside = lambda x, i: F.coalesce(same(x, F.get(windows, i)), F.lit(False))
    twice = F.filter(windows, lambda x, i: beside(x, i - 1) | beside(x, i + 1))
    places = F.array_sort(F.transform(twice, lambda x: x["at"]))
    start = F.struct(F.lit(-9).alias("last"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        places,
        start,
        lambda s, at: F.struct(at.alias("last"), (s["n"] + F.least(F.lit(3), at - s["last"])).alias("n")),
        lambda s: s["n"],
    )


def with_line_cleaning(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """``docs`` with base counts, the cleaned text, what was lost, and the verdict.

    Added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lines_failed (line rule -> lines),
    clean_text, lost_share and kept. Columns of these names in ``docs`` are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    cut = docs.withColumn("_words", F.array_remove(F.split(whole, BLANKS), "")).withColumn(
        "_lines", F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD))
    )
    n = F.size("_words")
    part = lambda k: F.slice("_words", k, F.greatest(n - 2, F.lit(0)))
    cut = cut.withColumn(
        "_windows",
        F.when(
            n > 2,
            F.arrays_zip(
                part(1).alias("a"), part(2).alias("b"), part(3).alias("c"), F.sequence(F.lit(1), n - 2).alias("at")
            ),
        ),
    )
    # Most texts repeat no window; equal hashes are the cheap sign that one may, and only then windows are compared.
    hashes = F.transform("_windows", lambda x: F.xxhash64(x["a"], x["b"], x["c"]))
    cut = cut.withColumn("_hashes", hashes)
    suspect = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    cut = cut.withColumn("_windows", F.when(suspect, F.array_sort("_windows"))).drop("_hashes")
    # A line that repeats an earlier one is boilerplate too: only its first copy is judged.
    cut = cut.withColumn("_first", F.array_distinct("_lines"))
    # Inside an array function each mention is worked out anew, so what rules share is made in a pass of its own.
    cut = cut.withColumn(
        "_judged",
        F.transform(
            F.transform("_first", seen_line),
            lambda seen: F.struct(seen["line"].alias("line"), line_verdict(seen, rules).alias("rule")),
        ),
    )
    passed = F.filter("_judged", lambda x: x["rule"].isNull())
    cut = cut.withColumn("_passed", F.transform(passed, lambda x: x["line"]))
    chars = lambda lines: F.aggregate(lines, F.lit(0).cast("bigint"), lambda s, x: s + F.char_length(x))
    failed = lambda rule: F.size(F.filter("_judged", lambda x: x["rule"] == rule))
    repeats = F.size("_lines") - F.size("_first")
    out = (
        cut.withColumn("n_words", n.cast("bigint"))
        .withColumn("word_chars", F.char_length(F.array_join("_words", "")).cast("bigint"))
        .withColumn("n_symbols", F.regexp_count(whole, F.lit(SYMBOLS)).cast("bigint"))
        .withColumn("n_dup_lines", repeats.cast("bigint"))
        .withColumn(
            "n_repeat_words",
            F.coalesce(repeated_words(F.col("_words"), F.col("_windows")), F.lit(0).cast("bigint")),
        )
        .withColumn("clean_text", F.array_join("_passed", "\n"))
        .withColumn("_all_chars", chars("_lines"))
        .withColumn("_lost_chars", F.col("_all_chars") - chars("_passed"))
        .withColumn(
            "lines_failed",
            F.create_map(
                F.lit("navigation"), failed("navigation"),
                F.lit("punctuation"), failed("punctuation"),
                F.lit("boilerplate"), failed("boilerplate") + repeats,
            ),
        )
    )
    out = (
        out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .withColumn("lost_share", F.try_divide(F.col("_lost_chars").cast("double"), F.col("_all_chars")))
        .withColumn(
            "kept",
            ~F.col("base_failed")
            & (F.size("_passed") > 0)
            & (F.col("_lost_chars") <= rules.lost_share * F.col("_all_chars")),
        )
    )
    # A filter on a result must not move below the steps that make it: it would repeat each step in the next. A row
    # number beside the results keeps it above.
    before = [c for c in docs.columns if c not in ADDED]
    held = out.select(*before, F.struct(*ADDED, F.monotonically_increasing_id().alias("row")).alias("_held"))
    return held.select(*before, *[F.col(f"_held.{c}").alias(c) for c in ADDED])


#: Bare SQL of the same rules, for the query over ``documents``.
SQL = r"""
WITH cut AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
spot AS (SELECT rid, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM cut),
win AS (
  SELECT rid, i, a, lead(a) OVER w AS b, lead(a, 2) OVER w AS c FROM spot WINDOW w AS (PARTITION BY rid ORDER BY i)),
cnt AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win WHERE c IS NOT NULL),
hit AS (SELECT DISTINCT rid, i + k AS i FROM cnt, (VALUES (0), (1), (2)) AS v(k) WHERE n > 1),
rep AS (SELECT rid, count(*) AS n FROM hit GROUP BY rid),
line AS (SELECT rid, unnest(list_distinct(lines)) AS l FROM cut),
counted AS (
  SELECT rid, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS w,
         len(regexp_extract_all(l, '\|')) AS bars, len(regexp_extract_all(l, '[#*$%&|<>]')) AS marks,
         len(regexp_extract_all(l, '[!?]{{2,}}')) AS shouts
  FROM line),
passed AS (
  SELECT rid, count(*) AS n, sum(length(l)) AS chars FROM counted
  WHERE NOT (bars >= {bars} * w OR marks >= {symbols} * w OR shouts >= {shouts} * w
             OR NOT regexp_matches(l, '{ends}') OR {notice})
  GROUP BY rid),
base AS (
  SELECT doc_id, rid, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         coalesce(list_sum(list_transform(lines, lambda l: length(l))), 0) AS chars
  FROM cut LEFT JOIN rep USING (rid)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND passed.n IS NOT NULL AND judged.chars - passed.chars <= {lost} * judged.chars AS kept
FROM judged LEFT JOIN passed USING (rid)
"""


def cleaning_sql(rules: LineRules = LineRules()) -> str:
    notice = " OR ".join(f"contains(lower(l), '{phrase}')" for phrase in BOILERPLATE)
    return SQL.format(
        bars=rules.bars_per_word,
        symbols=rules.symbols_per_word,
        shouts=rules.shouts_per_word,
        lost=rules.lost_share,
        ends=f"{SENTENCE_MARKS}|{UNMARKED}",
        notice=f"({notice})",
    )
