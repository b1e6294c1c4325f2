"""Text expressions. What Spark's functions express is a column; NFC, NFKC and case folding are Arrow functions."""

from __future__ import annotations

import itertools
import json
import re
import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lines that are page furniture as a whole (fixed values).
BOILERPLATE_LINES = ("accept all cookies", "back to top", "cookie preferences", "cookie settings", "log in", "menu", "privacy policy", "sign in", "skip to content", "subscribe", "terms of service")
#: Words that navigation bars consist of (fixed values).
NAVIGATION_WORDS = ("about", "blog", "contact", "home", "in", "log", "login", "menu", "news", "pricing", "privacy", "products", "search", "services", "sign", "subscribe")
NAVIGATION_MOST = 8
#: Patterns of lines (fixed values).
_COPYRIGHT = r"(?i)^(?:©|copyright\b).{0,100}\ball rights reserved\.?$"
_HEADING = r"^\s{0,3}#{1,6}\s+\S"
_LIST = r"^\s*(?:[-*+]\s+|\d+[.)]\s+)"
_FENCE = r"^\s*(```|~~~)"
_TABLE = r"^\s*\|(?:[^|]*\|){2,}\s*$"
#: What a line of page furniture begins with: anything else needs no closer look.
_MAYBE = r"(?i)^[^\p{L}\p{N}]*(?:©|copyright|" + "|".join(sorted({w.split(" ")[0] for w in (*BOILERPLATE_LINES, *NAVIGATION_WORDS)})) + ")"
_HEADING_TEXT = r"(?m)^[ \t]{0,3}#{1,6}[ \t]+(.+?)[ \t]*#*[ \t]*$"
_WORD = r"[\p{L}\p{N}]+(?:[’'\-][\p{L}\p{N}]+)*"
_ENTITY = r"(?<![\p{L}\p{N}_])[A-ZÜĞŞÇÖ][a-züğşçö]+(?:\s+[A-ZÜĞŞÇÖ][a-züğşçö]+)*(?![\p{L}\p{N}_])"
TURKISH = "[çğışöüÇĞİŞÖÜ]"


def empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def strip(c: Column) -> Column:
    """Without ASCII white space at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def has_value(c: Column) -> Column:
    """A text that is there and isn't empty."""
    return c.isNotNull() & (c != "")


def word_count(text: Column) -> Column:
    """Words of letters and digits, with inner apostrophes and hyphens."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0))


def space_count(text: Column) -> Column:
    """Runs without white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0))


def token_estimate(text: Column) -> Column:
    """Tokens on the safe side: a word counts a third of its UTF-8 bytes, rounded up, any other mark 1."""
    words = F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    in_words = F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.floor((F.octet_length(w) + 2) / 3).cast("long"))
    marks = F.regexp_count(text, F.lit(r"[^\p{L}\p{N}_\s]")).cast("long")
    return F.coalesce(in_words + marks, F.lit(0).cast("long"))


def is_boilerplate(line: Column) -> Column:
    """Page furniture: a set phrase, a copyright line, or a few words that are all navigation."""
    tidy = F.regexp_replace(F.lower(strip(line)), r"^[ .:;|\-]+|[ .:;|\-]+$", "")
    tokens = F.regexp_extract_all(tidy, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    navigation = F.size(tokens).between(1, NAVIGATION_MOST) & (F.size(F.array_except(tokens, F.array(*(F.lit(w) for w in NAVIGATION_WORDS)))) == 0)
    closer = (tidy != "") & (tidy.isin(*BOILERPLATE_LINES) | strip(line).rlike(_COPYRIGHT) | navigation)
    return F.coalesce(F.when(line.rlike(_MAYBE), closer).otherwise(False), F.lit(False))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def clean_plain(text: Column) -> Column:
    """Struct (content, removed): text without code fences and already in NFC, cleaned line by line.

    Line ends become LF and no-break spaces blanks; headings, list items and
    table lines keep their form; other lines have their blanks collapsed and go
    if they are page furniture; runs of empty lines become one, none is left at
    either end. Each line's form is made once, and looked at afterwards.
    """
    blanks = F.lit(" \t\x0b\x0c")
    tidy = F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n|\r", "\n"), "\u00a0", " ")
    lines = F.split(F.regexp_replace(tidy, r"(?m)[^\S\n]+$", ""), "\n", -1)

    def form(x: Column) -> Column:
        whole, listed = x.rlike(f"{_HEADING}|{_TABLE}"), x.rlike(_LIST)
        collapsed = F.btrim(F.regexp_replace(x, r"[\t ]+", " "), blanks)
        return F.when(whole, F.struct(F.btrim(x, blanks).alias("line"), F.lit(False).alias("plain"))).when(listed, F.struct(x.alias("line"), F.lit(False).alias("plain"))).otherwise(F.struct(collapsed.alias("line"), F.lit(True).alias("plain")))

    def joined(kept: Column) -> Column:
        return F.btrim(F.regexp_replace(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"), r"\n{3,}", "\n\n"), F.lit("\n"))

    stays = lambda x: ~(x["plain"] & is_boilerplate(x["line"]))
    return _let(F.transform(lines, form), lambda all_: _let(F.filter(all_, stays), lambda kept: F.struct(joined(kept).alias("content"), (F.size(all_) - F.size(kept)).alias("removed"))))


def needs_exact_cleaning(text: Column) -> Column:
    """Whether a text has code fences or any character that NFC or Unicode white space might concern."""
    return F.coalesce(text.rlike(r"(?m)^[^\S\n]*(```|~~~)") | text.rlike(r"[\x1c-\x1f\x85]|[^\x00-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]"), F.lit(False))


_IS_FENCE, _IS_LIST, _IS_WHOLE, _IS_COPYRIGHT = (re.compile(p) for p in (_FENCE, _LIST, f"{_HEADING}|{_TABLE}", _COPYRIGHT))


def _furniture(line: str) -> bool:
    """is_boilerplate for one line."""
    phrase = line.casefold().strip(" .:;|-")
    names = re.findall(r"[^\W_]+", phrase)
    all_navigation = 1 <= len(names) <= NAVIGATION_MOST and frozenset(NAVIGATION_WORDS).issuperset(names)
    return phrase != "" and (all_navigation or phrase in BOILERPLATE_LINES or _IS_COPYRIGHT.match(line) is not None)


def exact_clean(text: str | None) -> tuple[str, int]:
    """clean_plain for one text, with NFC and with code fences kept word for word.

    One pass marks the fences, one gives each line its form, one leaves out page
    furniture and what blank lines there are too many.
    """
    lines = [x.replace("\u00a0", " ").rstrip() for x in re.split("\r\n|\r|\n", unicodedata.normalize("NFC", text or ""))]
    marks = [_IS_FENCE.match(x) is not None for x in lines]
    code = [mark or opened % 2 == 1 for mark, opened in zip(marks, itertools.accumulate(marks), strict=True)]
    plain = [not c and not _IS_WHOLE.match(x) and not _IS_LIST.match(x) for c, x in zip(code, lines, strict=True)]

    def form(x: str, mark: bool, c: bool, p: bool) -> str:
        if p:
            return re.sub(r"[\t ]+", " ", x).strip()
        return x.strip() if mark or not c and _IS_WHOLE.match(x) else x

    formed = list(map(form, lines, marks, code, plain))
    stays = [not (p and _furniture(x)) for p, x in zip(plain, formed, strict=True)]
    kept = [(x, c) for x, c, s in zip(formed, code, stays, strict=True) if s]
    before = ["", *(x for x, _ in kept)]
    content = "\n".join(x for (x, c), last in zip(kept, before, strict=False) if x or c or last)
    return content.rstrip("\n"), len(stays) - sum(stays)


@F.pandas_udf(T.StructType([T.StructField("content", T.StringType()), T.StructField("removed", T.IntegerType())]))
def exact_clean_udf(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([exact_clean(t) for t in text], columns=["content", "removed"])


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.str.normalize("NFC")


@F.pandas_udf(T.StringType())
def folded(text: pd.Series) -> pd.Series:
    """NFKC, case-folded, white space collapsed: the form that identities are compared in."""
    return text.map(lambda t: None if t is None else " ".join(unicodedata.normalize("NFKC", t).casefold().split()))


def plain_folded(text: Column) -> Column:
    """folded for ASCII texts, as a column."""
    return F.lower(strip(F.regexp_replace(text, r"\s+", " ")))


def content_status(text: Column, words: Column, least: int) -> Column:
    return F.when(F.coalesce(strip(text), F.lit("")) == "", "empty").when(words < least, "thin").otherwise("usable")


def first_words(text: Column, most: int) -> Column:
    """The text up to its ``most``-th run without white space, its spacing kept."""
    return strip(F.regexp_extract(F.coalesce(text, F.lit("")), rf"^\s*\S+(?:\s+\S+){{0,{most - 1}}}", 0))


def headings(markdown: Column, most: int = 50) -> Column:
    return F.slice(F.filter(F.transform(F.regexp_extract_all(F.coalesce(markdown, F.lit("")), F.lit(_HEADING_TEXT), F.lit(1)), strip), lambda h: h != ""), 1, most)


def structure_hints(markdown: Column, found_headings: Column) -> Column:
    """Names of the structures that a Markdown text has, in a fixed order."""
    tests = (
        (F.size(found_headings) > 0, "headings"), (markdown.rlike(r"(?m)^\s*[-+*]\s+\S"), "unordered_list"), (markdown.rlike(r"(?m)^\s*\d+[.)]\s+\S"), "ordered_list"),
        (markdown.rlike(r"(?m)^\s*\|.+\|\s*$"), "table"), (markdown.contains("```"), "code_block"), (markdown.rlike(r"\[[^\]]+\]\([^)]+\)"), "links"),
    )
    return F.array_compact(F.array(*(F.when(test, name) for test, name in tests)))


def folds_oddly(content: Column) -> Column:
    """Whether letters occur whose case doesn't fold one to one."""
    return content.rlike("[\u0130\u0131\u017f\u03a3\u03c2\u03c3\u212a]")


def evidence_slice(content: Column, candidate: Column, folded_content: Column | None = None) -> Column:
    """The piece of content that a candidate is found as, word for word or, failing that, with any case and white space; else null.

    A pattern is only made where the folded texts hold one another, or where
    letters occur whose case doesn't fold one to one. ``folded_content``: the
    content's plain_folded form, where it is there already.
    """
    want = strip(candidate)
    escaped = F.regexp_replace(want, r"([\\\[\](){}.*+?^$|])", r"\\$1")
    pattern = F.concat(F.lit("(?iu)"), F.regexp_replace(escaped, r"\s+", r"\\s+"))
    loose = F.call_function("regexp_extract", content, pattern, F.lit(0))
    folded = plain_folded(content) if folded_content is None else folded_content
    may = F.contains(folded, plain_folded(candidate)) | folds_oddly(content)
    return F.when(want == "", None).when(F.contains(content, want), want).when(may, empty_to_null(loose))


@F.pandas_udf(T.ArrayType(T.StringType()))
def nested_atoms(value: pd.Series) -> pd.Series:
    """The scalars of a list or object in JSON, at any depth, as texts; null ones and empty ones are left out."""

    def of(item) -> list[str]:
        if isinstance(item, (list, dict)):
            return [x for inner in (item.values() if isinstance(item, dict) else item) for x in of(inner)]
        return [] if item in (None, "") else [str(item).strip()]

    return value.map(lambda v: None if v is None else of(json.loads(v)))


def atoms(value: Column) -> Column:
    """The scalars that a field's value consists of: itself, or those of a list or object in JSON."""
    nested = value.rlike(r"^\s*[\[{]") & F.coalesce(F.schema_of_variant(F.try_parse_json(value)).rlike("^(ARRAY|OBJECT)"), F.lit(False))
    return F.coalesce(nested_atoms(F.when(nested, value)), F.array(strip(value)))


def entities(text: Column) -> Column:
    """Runs of capitalised words, first mentions in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_ENTITY), F.lit(0)))


def entity_type(name: Column, keywords: Mapping[str, str]) -> Column:
    """Type of the first keyword that the name contains, else UNKNOWN."""
    out = F.lit("UNKNOWN")
    for keyword, kind in reversed(list(keywords.items())):
        out = F.when(F.lower(name).contains(keyword.lower()), kind).otherwise(out)
    return out


def language_guess(text: Column) -> Column:
    """tr if a Turkish letter occurs, else en. French and German texts with ç, ö or ü count as tr, too."""
    return F.when(F.coalesce(text, F.lit("")).rlike(TURKISH), "tr").otherwise("en")


def document_type(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.contains("<html") | low.contains("<body"), "html").when(F.regexp_extract(text, r"^\s*(.)", 1).isin("{", "["), "json").otherwise("text")


def category(text: Column, names: Sequence[str]) -> Column:
    out = F.lit("general")
    for name in reversed(list(names)):
        out = F.when(F.lower(text).contains(name.lower()), name).otherwise(out)
    return out


def normalised(text: Column, replacements: Mapping[str, str] = {}, composed: bool = True) -> Column:  # noqa: B006
    """White space collapsed, then literal replacements in their order. ``composed``: the text is in NFC already."""
    out = strip(F.regexp_replace(text if composed else nfc(text), r"\s+", " "))
    for old, new in replacements.items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def label(value: Column) -> Column:
    """A policy label: trimmed, lower-cased, blanks and hyphens as underscores."""
    return F.translate(F.lower(strip(value)), " -", "__")


def labels(values: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), label), lambda x: x != ""))


#: The end of a word of letters and digits of ASCII alone; Java's own takes any script's.
_ASCII_EDGE = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"


def contradicts(kind: Column, value: Column, evidence: Column, ascii_words: bool = False) -> Column:
    """Whether evidence says the opposite: of a boolean, its contrary words without its own; of a text, ``not`` or ``no`` before it.

    ``ascii_words``: that text ends where letters and digits of ASCII do, as SQL engines on RE2 have it.
    """
    before, after = (r"(?<![0-9A-Za-z_])", _ASCII_EDGE) if ascii_words else (r"\b", r"\b")
    low = strip(F.regexp_replace(F.lower(evidence), r"\s+", " "))
    tokens = F.regexp_extract_all(low, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    yes, no = (F.array(*(F.lit(x) for x in words)) for words in (("true", "yes", "on"), ("false", "no", "off")))
    is_true = F.lower(value) == "true"
    wrong = F.when(is_true, F.arrays_overlap(tokens, no) & ~F.arrays_overlap(tokens, yes)).otherwise(F.arrays_overlap(tokens, yes) & ~F.arrays_overlap(tokens, no))
    escaped = F.regexp_replace(F.regexp_replace(strip(F.lower(value)), r"([\\\[\](){}.*+?^$|])", r"\\$1"), r"\s+", r"\\s+")
    denied = F.regexp_like(low, F.concat(F.lit(rf"{before}(?:not|no)\s+"), escaped, F.lit(after)))
    return F.coalesce(F.when(kind == "boolean", wrong).when(kind == "string", denied), F.lit(False))


def title_label(field: str) -> str:
    return field.replace("_", " ").strip().title()
