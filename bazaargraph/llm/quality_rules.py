"""Quality rules, line first: bad lines go, then documents that lost too much text.

A line (split at ``\\n``) with a word is removed if one of these holds:

* punctuation: it has no sentence mark at all, or symbols, or runs of exclamation or
  question marks, in more than a fifth of its words;
* navigation: separators of items in at least a third of its words, or all its words
  are names of menu entries;
* boilerplate: it has a phrase of notices or forms, a curly bracket, or it repeats an
  earlier line of its document.

A document is kept if it passes the base rules (at least ``LEAST_WORDS`` words, not
more than half of its words in repeated windows of three words) and the remaining
lines hold at least ``LEAST_LEFT`` percent of its characters in words. Words are
``[^\\x20\\x09-\\x0D]+``; characters are code points.

Everything is an expression over one row, so nothing is shuffled and a hot source or
a group of copies changes nothing. Windows are sorted by a hash and their words, so
repeats are exact and cost n log n in the length of a text. Null and empty texts have
no words and no lines, fail the base rules and are not kept. Every row is answered on
its own, repeated rows and rows with a null doc_id, too; other columns don't matter.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 50  # fixed values of the task: words, and percent of repeated words
MOST_REPEATED = 50
LEAST_LEFT = 60  # percent of the characters in words
BLANKS = r"[\x20\x09-\x0D]+"
WORDY = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MARK = r"[.!?…。！？؟।]"
SHOUT = r"[!?]{2,}"
SEPARATORS = ("|", ">", ">>", "/", "»", "›", "•", "·", "::")
ENTRY = (
    r"^([ \t|>»·-]*"
    r"\b(home|menu|login|log in|sign in|sign up|register|search|next|previous|prev|back|top|"
    r"contact|contact us|about|about us|sitemap|share|print|reply|comments?|read more|more|"
    r"accueil|connexion|suivant|startseite|anmelden|weiter|inicio|siguiente)\b)+[ \t|>.»·-]*\z"
)
ENTRY_WORDS = 10  # longer lines are no menus of names alone
BOILERPLATE = (
    "lorem ipsum", "all rights reserved", "terms of use", "terms of service",
    "terms and conditions", "privacy policy", "cookie policy", "uses cookies",
    "enable javascript", "click here", "subscribe to", "sign up for", "powered by",
    "copyright ©", "{", "}",
)
SHARE = 5  # more than one word in so many
ITEMS = 3  # a separator in each so many words


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def _measured_line(line: Column) -> Column:
    """What the rules ask of a line, each taken once."""
    words = _words(line)
    return F.struct(
        line.alias("line"),
        F.lower(line).alias("low"),
        F.size(words).alias("words"),
        F.size(F.filter(words, lambda w: w.isin(*SEPARATORS))).alias("separators"),
        F.regexp_count(line, F.lit(f"{SYMBOLS}+")).alias("symbols"),
        F.regexp_count(line, F.lit(SHOUT)).alias("shouts"),
    )


def _failed(x: Column) -> Column:
    words = x["words"]
    punctuation = (
        (x["symbols"] * SHARE > words) | (x["shouts"] * SHARE > words) | ~x["line"].rlike(MARK)
    )
    navigation = (x["separators"] > 0) & (x["separators"] * ITEMS >= words) | (
        words <= ENTRY_WORDS
    ) & x["low"].rlike(ENTRY)
    notices = (F.contains(x["low"], F.lit(phrase)) for phrase in BOILERPLATE)
    return punctuation | navigation | reduce(or_, notices)


def _windows(words: Column) -> Column:
    """Each window of three words with its place, equal ones side by side."""
    three = F.arrays_zip(
        words.alias("first"),
        F.slice(words, F.lit(2), F.size(words)).alias("second"),
        F.slice(words, F.lit(3), F.size(words)).alias("third"),
    )
    placed = F.transform(
        F.slice(three, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda x, i: F.struct(
            F.xxhash64(x["first"], x["second"], x["third"]).alias("hash"),
            *(x[name].alias(name) for name in ("first", "second", "third")),
            i.alias("at"),
        ),
    )
    return F.sort_array(placed)


def _following(values: Column) -> Column:
    return F.slice(values, F.lit(2), F.size(values))


def _repeats(windows: Column) -> Column:
    """The places of the windows that occur twice or more, in order."""

    def places(b: Column, a: Column) -> Column:
        same = (a[name] == b[name] for name in ("hash", "first", "second", "third"))
        return F.when(reduce(and_, same), F.array(a["at"], b["at"]))

    pairs = F.zip_with(_following(windows), windows, places)
    return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))


def _covered(places: Column) -> Column:
    """Words in the windows: each start covers three, or as many as before the next start."""
    steps = F.zip_with(
        _following(places), places,
        lambda b, a: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)).cast("long"),
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)


def _once(df: DataFrame, *columns: Column) -> DataFrame:
    """``df.select(columns)``, computed once per row: as the fields of a generated row, they
    are neither merged into later expressions nor repeated in a filter pushed below."""
    return df.select(*columns).select(F.inline(F.array(F.struct("*"))))


def judge_lines(docs: DataFrame) -> DataFrame:
    """Counts, the cleaned text and the verdict for each row of ``docs`` (doc_id, text, ...)."""
    text, words, lines = F.col("text"), F.col("words"), F.col("lines")
    split = _once(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")),
        F.col("doc_id"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _words(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORDY)).alias("lines"),
    )
    distinct = F.array_distinct(lines)
    counted = _once(
        split,
        F.col("doc_id"), F.col("n_symbols"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.size(words).cast("long").alias("n_words"),
        (F.size(lines) - F.size(distinct)).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        F.filter(F.transform(distinct, _measured_line), lambda x: ~_failed(x))["line"].alias("left"),
        _windows(words).alias("windows"),
    )
    placed = _once(counted, F.col("*"), _repeats(F.col("windows")).alias("places"))
    measured = _once(
        placed,
        *(F.col(c) for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines")),
        _covered(F.col("places")).alias("n_repeat_words"),
        F.col("n_lines"),
        F.size("left").cast("long").alias("n_lines_left"),
        F.array_join("left", "\n").alias("cleaned"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    left = F.length(F.array_join(_words(F.col("cleaned")), ""))
    enough = 100 * left.cast("long") >= LEAST_LEFT * F.col("word_chars")
    return measured.select("*", failed.alias("base_failed"), (~failed & enough).alias("kept"))


def cleaned_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns, with the cleaned text as ``text``."""
    whole = docs.select(F.struct("*").alias("doc_id"), "text")
    kept = judge_lines(whole).where("kept")
    return kept.select(
        *(
            F.col("cleaned").alias(c) if c == "text" else F.col("doc_id").getField(c).alias(c)
            for c in docs.columns
        )
    )


def check_quality(docs: DataFrame) -> DataFrame:
    """``judge_lines`` without the text."""
    return judge_lines(docs).drop("cleaned")
