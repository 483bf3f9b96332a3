"""Six text normalisers that look alike and aren't interchangeable, and other text clean-up.

Unicode normal forms, case folding and HTML entities aren't among Spark's functions; these steps are
one Arrow function for each normaliser, to be applied once to a column and reused. All are of one kind, so that
Spark evaluates those of one step in one Python worker.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

_NOT_ASCII = r"[^a-z0-9]+"


def _fold(text: str) -> str:
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


class _Characters(dict):
    """What becomes of each character of a text, for str.translate: told once for a character while they are few."""

    def __init__(self, told) -> None:
        self.told = told

    def __missing__(self, point: int) -> str:
        made = self.told(chr(point))
        if len(self) < 1 << 16:
            self[point] = made
        return made


def _only_ascii(case):
    """Characters of decomposed texts: without combining marks, and a space for what is no letter or digit of ASCII in this case."""
    return _Characters(lambda c: "" if unicodedata.combining(c) else "".join(x if x.isascii() and x.isalnum() else " " for x in case(c)))


#: What _letters_and_numbers makes of each ASCII character, and _words.
_ASCII = {i: chr(i).lower() if chr(i).isalnum() else " " for i in range(128)}
_ASCII_WORDS = _ASCII | {ord("_"): "_"}
_LETTERS = _Characters(lambda c: c if unicodedata.category(c)[0] in "LN" else " ")
_LOWERED, _CASEFOLDED = _only_ascii(str.lower), _only_ascii(str.casefold)


def _letters_and_numbers(text: str) -> str:
    if text.isascii():
        return " ".join(text.translate(_ASCII).split())
    return " ".join(unicodedata.normalize("NFKC", text).casefold().translate(_LETTERS).split())


def _ascii_of(text: str, characters: dict) -> str:
    if text.isascii():
        return " ".join(text.translate(_ASCII).split())
    return " ".join(unicodedata.normalize("NFKD", text).translate(characters).split())


#: Characters of texts that a function holds as Python strings at once; longer texts are taken one by one.
SLICE = 1 << 20


def _slices(values: pa.Array) -> Iterator[list]:
    """The values as lists, of one value or of some SLICE bytes each."""
    n = len(values)
    step = max(1, n * SLICE // max(values.nbytes, 1))
    return (values.slice(at, step).to_pylist() for at in range(0, n, step))


def _vectorised(plain):
    @F.arrow_udf(StringType())
    def run(values: pa.Array) -> pa.Array:
        made = []
        for some in _slices(values):
            known: dict = {None: None}
            made.append(pa.array([known[x] if x in known else known.setdefault(x, plain(x)) for x in some], pa.string()))
        return pa.concat_arrays(made) if made else pa.array([], pa.string())

    return run


def _words(text: str) -> str:
    if text.isascii() and "&" not in text:
        return " ".join(text.translate(_ASCII_WORDS).split())
    return re.sub(r"[^\w]+", " ", _fold(unicodedata.normalize("NFKD", html.unescape(text)).casefold())).strip()


_unicode = _vectorised(_letters_and_numbers)
_ascii_fold = _vectorised(lambda x: _fold(x).lower())
_word = _vectorised(_words)
_ngo = _vectorised(lambda x: _fold(x).casefold())
_unescape = _vectorised(html.unescape)
_taxonomy = _vectorised(lambda x: _taxonomy_key(x))


def _or_empty(value: Column | str) -> Column:
    return F.coalesce((F.col(value) if isinstance(value, str) else value).cast("string"), F.lit(""))


def norm_unicode(value: Column | str) -> Column:
    """NFKC, case folded; whatever isn't a letter or a number becomes a space. Keeps Arabic."""
    return _unicode(_or_empty(value))


def norm_ascii_fold(value: Column | str) -> Column:
    """NFKD without combining marks, lower case, runs of anything but a-z and 0-9 become a space."""
    return F.trim(F.regexp_replace(_ascii_fold(_or_empty(value)), _NOT_ASCII, " "))


def norm_word(value: Column | str) -> Column:
    """Entities resolved, folded, runs of non-word characters become a space. Underscores and Arabic stay."""
    return _word(_or_empty(value))


def norm_ngo(value: Column | str) -> Column:
    """Like norm_ascii_fold, but case folded, so that a sharp s becomes ss. Arabic becomes empty."""
    return F.trim(F.regexp_replace(_ngo(_or_empty(value)), _NOT_ASCII, " "))


#: Legal suffixes that don't tell organisations apart.
LEGAL_SUFFIXES = ("limited", "ltd", "incorporated", "inc", "plc", "llc", "company", "co")


#: Before a text that is only case folded: what its words are is left to Java's pattern.
_FOLDED = "\0"
_ASCII_ONLY = _Characters(lambda c: c if c.isascii() and c.isalnum() else " ")


def _dedup_key(text: str) -> str:
    text = text.casefold()
    if text.isascii():  # a legal suffix is a whole run of letters, digits and underscores
        told = " ".join([w for w in text.translate(_ASCII_WORDS).split() if w not in LEGAL_SUFFIXES])
        return " ".join(told.replace("_", " ").split()) if "_" in told else told
    return _FOLDED + text if any(s in text for s in LEGAL_SUFFIXES) else " ".join(text.translate(_ASCII_ONLY).split())


_dedup = _vectorised(lambda x: _dedup_key(x))


def norm_dedup(value: Column | str) -> Column:
    """Case folded, legal suffixes dropped, no Unicode folding: an accented letter becomes a space.

    Suffixes in texts of other scripts are left to a pattern of the JVM, whose classes of characters aren't Python's.
    """
    found = _dedup(_or_empty(value))
    bare = F.regexp_replace(F.substring(found, 2, 1 << 30), rf"(?U)\b({'|'.join(LEGAL_SUFFIXES)})\b", " ")
    return F.when(found.startswith(_FOLDED), F.trim(F.regexp_replace(bare, _NOT_ASCII, " "))).otherwise(found)


def _taxonomy_key(text: str) -> str:
    if text.isascii() and text.isprintable() and "&" not in text:
        return " ".join(text.split()).lower()
    return re.sub(r"[^\S\x1c-\x1f]+", " ", html.unescape(text)).strip(" ").casefold()


def taxonomy_key(value: Column | str) -> Column:
    """Entities resolved, white space collapsed, case folded. Punctuation stays."""
    return _taxonomy(_or_empty(value))


@F.arrow_udf(ArrayType(StringType()))
def _keys_of(values: pa.Array) -> pa.Array:
    known: dict = {None: ""}
    return pa.array([None if xs is None else [known[x] if x in known else known.setdefault(x, _taxonomy_key(x)) for x in xs] for xs in values.to_pylist()], pa.list_(pa.string()))


def taxonomy_keys(values: Column | str) -> Column:
    """taxonomy_key of each element of an array; null elements become empty."""
    return _keys_of(values)


def slug(value: Column | str) -> Column:
    return F.regexp_replace(norm_ascii_fold(value), " ", "-")


#: Normalisers as plain functions of a text, for steps that match in the same pass over a batch.
PLAIN = {
    norm_unicode: _letters_and_numbers,
    norm_word: _words,
    norm_ascii_fold: lambda x: _ascii_of(x, _LOWERED),
    norm_ngo: lambda x: _ascii_of(x, _CASEFOLDED),
}


def html_to_text(markup: Column | str, max_chars: int = 300) -> Column:
    """text of a fragment of HTML, white space collapsed, cut to max_chars and "..."; null if there is none.

    Bodies of script and style stay out of the way of tags only, as in a plain tag stripper: their text is kept.
    """
    bare = F.regexp_replace(_or_empty(markup), r"(?s)<!--.*?-->|<!\w[^>]*>|<\?[^>]*>|</?[A-Za-z][^>]*>", "")
    text = F.trim(F.regexp_replace(_unescape(bare), r"(?U)\s+", " "))
    cut = F.when(F.length(text) > max_chars, F.concat(F.substring(text, 1, max_chars), F.lit("..."))).otherwise(text)
    return F.when(text != "", cut)


def summary_text(*parts: Column | str) -> Column:
    """Several fragments joined by a space, as text."""
    return html_to_text(F.concat_ws(" ", *parts))
