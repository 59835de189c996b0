"""Column functions for tokenizing and normalizing text.

Every function takes and returns Columns, so a tokenizer is a plain projection
over the documents and runs where the scan runs, with no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on them exactly.
TOKEN_DELIMITERS = r'[ \t\n!,"]+'
TOKEN = r'[^ \t\n!,"]+'  # what split_tokens leaves
WORD_CHAR = r"\w"
LINE_TERMINATOR = r"[\n\r\u0085\u2028\u2029]"
REMOVED = r"\[\](){}'"
BLANK = r"\x00-\x20"
ID_TOKEN_PREFIX = "itemid_"
TRIMMED_CHARS = "".join(chr(c) for c in range(0x21))

# What normalizing removes: removed characters anywhere, blanks next to either
# end, and one ',' then ':' then '.' at the end. A run of blanks is tried once,
# from its start, so that long runs stay linear.
NOT_TERM = (
    rf"^[{REMOVED}{BLANK}]++"
    rf"|(?<![{REMOVED}{BLANK}])[{REMOVED}{BLANK}]*+(?:,[{BLANK}]*+)?(?::[{BLANK}]*+)?(?:\.[{BLANK}]*+)?\z"
    rf"|[{REMOVED}]"
)


# A token without any of these is its own term.
MAY_NORMALIZE = rf"[{REMOVED}{BLANK}]|[,:.]\z"


def trim_control(value: Column) -> Column:
    """Trim blanks and every other character up to U+0020."""
    return F.trim(value, F.lit(TRIMMED_CHARS))


def plain_body(text: Column) -> Column:
    """Indexable string of a document that has only a text."""
    return F.lower(F.coalesce(text, F.lit("")))


def news_body(title: Column, text: Column) -> Column:
    """Indexable string of a news item: title, then text, without quotes.

    The headline is display data and takes no part in the index.
    """
    parts = [
        F.translate(trim_control(F.coalesce(part, F.lit(""))), '"', "")
        for part in (title, text)
    ]
    return F.lower(F.concat_ws(" ", *parts))


def with_id_token(body: Column, doc_id: Column) -> Column:
    """Prefix the document-id token that takes position 1."""
    return F.concat(F.lit(ID_TOKEN_PREFIX), doc_id.cast("string"), F.lit(" "), body)


def split_tokens(body: Column) -> Column:
    """All non-empty tokens, punctuation-only ones included."""
    return F.array_remove(F.split(body, TOKEN_DELIMITERS), "")


def split_on_blanks(body: Column) -> Column:
    """Tokens between single blanks; line breaks stay inside a token."""
    return F.array_remove(F.split(body, " "), "")


def is_word(token: Column) -> Column:
    """True where a token has an ASCII word character and no line terminator."""
    return token.rlike(WORD_CHAR) & ~token.rlike(LINE_TERMINATOR)


def normalize_term(raw: Column) -> Column:
    """Term of a lower-case token, without brackets, quotes and end marks."""
    return F.when(raw.rlike(MAY_NORMALIZE), F.regexp_replace(raw, NOT_TERM, "")).otherwise(raw)


def normalizer() -> Callable[[str], str]:
    """``normalize_term`` of a token in a Python worker, whose end of text is written otherwise."""
    may, removed = (re.compile(pattern.replace(r"\z", r"\Z")) for pattern in (MAY_NORMALIZE, NOT_TERM))
    return lambda raw: removed.sub("", raw) if may.search(raw) else raw


def normalized(raws: list[str]) -> list[str]:
    """``normalize_term`` of tokens in a Python worker."""
    return list(map(normalizer(), raws))


def is_one_of(raw: Column, words: list[str]) -> Column:
    """True where a token, blanks around it trimmed, is one of ``words``."""
    return trimmed_token(raw).isin(words)


def trimmed_token(raw: Column) -> Column:
    """A token without the blanks around it. Tokens rarely hold a blank, so the
    costly trim is kept behind a cheap test."""
    return F.when(raw.rlike(f"[{BLANK}]"), trim_control(raw)).otherwise(raw)


def split_query(query: Column) -> Column:
    """Whitespace-separated parts of a query string."""
    return F.array_remove(F.split(query, r"\s+"), "")
