"""Text functions as column expressions; everything here stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values -----------------------------------------------------------
WHITESPACE = " \t\r\n\x0b\x0c"
WORD = r"[A-Za-z0-9À-ÿ]+(?:['-][A-Za-z0-9À-ÿ]+)*"
TOKEN = WORD + r"|[^\sA-Za-z0-9À-ÿ]"
PUNCTUATION = r"([!-/:-@\[-`{-~])"
SENTENCE_BREAK = "[.?!]"
END_TOKENS = [".", "!", "?", "...", "'", "`", '"', "’", "”", ")"]
STORY_OMIT = ["``", "-rrb-", "-lrb-", "--", "..."]
HIGHLIGHT = "@highlight"
SENTENCE_START, SENTENCE_END = "<s>", "</s>"
UNKNOWN, PAD, START, STOP = "[UNK]", "[PAD]", "[START]", "[STOP]"
UNKNOWN_ID, PAD_ID, START_ID, STOP_ID = 0, 1, 2, 3
PRIVATE_MARK = "pa_"
GENERATED_MARK = "Generated Concept:"
CONCEPT_PLACEHOLDER = "Concept to be generated"
# ------------------------------------------------------------------------


def strip(text: Column) -> Column:
    """Remove white space at both ends (all kinds, not only blanks)."""
    return F.btrim(text, F.lit(WHITESPACE))


def digits_key(key: Column) -> Column:
    """The digits of a textual key as a long; null when there are none or too many."""
    return F.regexp_replace(key.cast("string"), "[^0-9]", "").try_cast("long")


def one_line(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def normal(text: Column) -> Column:
    """Trimmed lower-case form used for labels and concepts."""
    return F.lower(strip(text))


def sha1_key(url: Column) -> Column:
    """SHA-1 of a public URL; private ids are kept as they are."""
    return F.when(F.contains(url, F.lit(PRIVATE_MARK)), url).otherwise(F.sha1(url))


def close_line(line: Column) -> Column:
    """Append `` .`` to a line that lacks a closing mark."""
    complete = (
        F.contains(line, F.lit(HIGHLIGHT))
        | (line == "")
        | F.right(line, F.lit(1)).isin(END_TOKENS)
    )
    return F.when(complete, line).otherwise(F.concat(line, F.lit(" .")))


def drop_literals(text: Column, literals: list[str]) -> Column:
    for item in literals:
        text = F.replace(text, F.lit(item), F.lit(""))
    return text


def tag_sentences(sentences: Column) -> Column:
    """``<s> a </s> <s> b </s>`` from an array of sentences."""
    tagged = F.transform(
        sentences,
        lambda s: F.concat(F.lit(SENTENCE_START + " "), s, F.lit(" " + SENTENCE_END)),
    )
    return F.array_join(tagged, " ")


def untag_sentences(abstract: Column) -> Column:
    """The trimmed sentences of a tagged abstract."""
    found = F.regexp_extract_all(abstract, F.lit("(?s)<s>(.*?)</s>"), F.lit(1))
    return F.transform(found, strip)


def split_blank(text: Column) -> Column:
    """Tokens between single blanks, empty ones removed."""
    return F.filter(F.transform(F.split(text, " "), strip), lambda t: t != "")


def split_space(text: Column) -> Column:
    """Tokens between runs of white space."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def tokens(text: Column) -> Column:
    """Words (inner apostrophes and hyphens kept) and single punctuation marks."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def sentences(text: Column) -> Column:
    """Sentences with their closing mark."""
    return F.filter(F.split(text, r"(?<=[.?!])\s+"), lambda s: s != "")


def fragments(text: Column) -> Column:
    """Trimmed, non-empty spans between sentence breakers."""
    return F.filter(F.transform(F.split(text, SENTENCE_BREAK), strip), lambda s: s != "")


def period_sentences(text: Column) -> Column:
    """Sentences of a blank-separated token text, cut after each ``.`` token."""
    marked = F.regexp_replace(F.concat(F.lit(" "), text, F.lit(" ")), r" \.(?= )", " .\n")
    return F.filter(F.transform(F.split(marked, "\n"), strip), lambda s: s != "")


def space_punctuation(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, PUNCTUATION, " $1 "))


def clean_generated(text: Column) -> Column:
    """Repair generated text: sentence joints and bracket marks."""
    text = F.replace(text, F.lit(" ."), F.lit(". "))
    return drop_literals(text, ["-lrb-", "-rrb-"])


def is_upper(token: Column) -> Column:
    return (token == F.upper(token)) & (token != F.lower(token))


def acronyms(text: Column) -> Column:
    """Distinct upper-case tokens of a text, except ``A``."""
    return F.array_distinct(F.filter(tokens(text), lambda t: is_upper(t) & (t != "A")))


def restore_acronyms(token_array: Column, known: Column) -> Column:
    return F.transform(
        token_array,
        lambda t: F.when(F.array_contains(known, F.upper(t)), F.upper(t)).otherwise(t),
    )


def html_safe(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def until_stop(word_array: Column) -> Column:
    """The words before the first ``[STOP]``."""
    at = F.array_position(word_array, STOP)
    return F.when(at > 0, F.slice(word_array, F.lit(1), (at - 1).cast("int"))).otherwise(word_array)


def id_list(text: Column) -> Column:
    """Ids of a printed list such as ``[1, 2, 3]``."""
    return F.split(F.regexp_replace(text, r"[\[\] ]", ""), ",")


def leading_number(file_name: Column) -> Column:
    """``000012_decoded.txt`` → 12."""
    return F.nullif(F.regexp_extract(file_name, r"([0-9]+)_[^/]*$", 1), F.lit("")).cast("long")


def after_marker(text: Column) -> Column:
    """Everything on the lines after the generated-text marker; null without it."""
    return F.nullif(
        F.regexp_extract(text, "(?s)" + GENERATED_MARK + r"[^\n]*\n(.*)", 1), F.lit("")
    )


def exclude_tokens(token_array: Column, omit: list[str]) -> Column:
    """Tokens that are not in ``omit`` (compared in lower case)."""
    return F.filter(token_array, lambda t: ~F.lower(t).isin(omit))


def run_name(split: Column, max_enc: int, beam: int, min_dec: int, max_dec: int,
             checkpoint: Column | None = None) -> Column:
    """Descriptive directory name of one text-generation run."""
    base = F.format_string(
        f"decode_%s_{max_enc}maxenc_{beam}beam_{min_dec}mindec_{max_dec}maxdec", split
    )
    if checkpoint is None:
        return base
    return F.when(checkpoint.isNull(), base).otherwise(F.concat(base, F.lit("_"), checkpoint))


def dataset_of(path: Column) -> Column:
    """``train``, ``val`` or ``test``, whichever the path names first in that order."""
    return (
        F.when(F.contains(path, F.lit("train")), "train")
        .when(F.contains(path, F.lit("val")), "val")
        .when(F.contains(path, F.lit("test")), "test")
        .otherwise(F.raise_error(F.concat(F.lit("no train, val or test in "), path)))
    )
