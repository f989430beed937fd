"""Cleaning, tokenising and preview expressions, all ``Column -> Column``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.  Java's \s and \w know ASCII only, so both classes are spelled
# out: SPACE holds the Unicode white space characters and the four separator
# controls (SPACE_CHARS lists the same), WORD letters, numbers and the underscore
# (vowel signs are not in it).
SPACE = r"\p{IsWhite_Space}\x1c-\x1f"
SPACE_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
WORD = r"\p{L}\p{N}_"
URL = rf"(?iu)(?:https?://|www\.|t\.co/)[^{SPACE}]+"
MENTION = rf"@[{WORD}]+"
# Characters that count as a digit: decimal digits plus super- and subscript,
# circled, parenthesised and similar single digits.
DIGIT = (
    r"\p{Nd}\xb2\xb3\xb9\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}"
    r"\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}"
    r"\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, "")


def strip_mentions(text: Column) -> Column:
    return F.regexp_replace(text, MENTION, "")


def collapse_ws(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def clean_text(text: Column) -> Column:
    """One pass of URLs, then mentions, then white space; a URL that only the
    removal of a mention brings to light stays.

    Most text has neither, and a substring test is far cheaper than a pattern:
    a URL needs a slash or ``www.``, a mention an at sign.
    """
    may_have_url = text.contains("/") | F.lower(text).contains("www.")
    without_urls = F.when(may_have_url, strip_urls(text)).otherwise(text)
    without_mentions = F.when(text.contains("@"), strip_mentions(without_urls)).otherwise(without_urls)
    return collapse_ws(without_mentions)


def strip_ws(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def is_blank(text: Column) -> Column:
    return strip_ws(text) == ""


def is_digits(text: Column) -> Column:
    return text.rlike(f"^[{DIGIT}]+$")


def tokens_of(text: Column) -> Column:
    """Tokens between runs of white space; empty text has no tokens."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def clean_tokens(text: Column) -> Column:
    """``tokens_of`` for text that ``clean_text`` already brought to single blanks."""
    return F.array_remove(F.split(text, " "), "")


def clean_token_count(text: Column) -> Column:
    """Size of ``clean_tokens`` without building the array."""
    blanks = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(text == "", 0).otherwise(blanks + 1)


def clean_pairs(tokens: Column, tags: Column) -> Column:
    """Tokens after cleaning, each with the tag of the token it came from, as an array of (token, tag).

    No match of the text rules crosses white space, so cleaning joined tokens is cleaning each by itself: one may
    vanish, or fall into several if it holds white space, and its tag goes or is repeated with it. Tokens beyond
    the last tag have a null tag, tags beyond the last token go.
    """

    def kept(token: Column, place: Column) -> Column:
        tag = F.get(tags, place)
        return F.transform(clean_tokens(clean_text(token)), lambda t: F.struct(t.alias("token"), tag.alias("tag")))

    return F.flatten(F.transform(tokens, kept))


def text_of(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def ascii_preview(text: Column, width: int = 70) -> Column:
    """At most ``width`` characters for a terminal, one ``?`` per non-ASCII character."""
    return F.substring(F.regexp_replace(text, r"[^\x00-\x7f]", "?"), 1, width)


def text_preview(text: Column, width: int = 80) -> Column:
    return F.substring(text, 1, width)


def token_preview(tokens: Column, n: int = 10) -> Column:
    return F.slice(tokens, 1, n)
