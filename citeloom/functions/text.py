"""Text normalisation as plain column expressions.

Each function takes a column (or its name) of strings and returns a column;
all stay on the JVM inside the scan stage.
"""

from __future__ import annotations

import string
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, functions as F, types as T

from citeloom.constants import ELIDED_ARTICLES, LATE_CAPITALS, LATE_FORMATS, LATE_MARKS, LATE_WORDS

PUNCTUATION = r"[!-/:-@\[-`{-~]"
IDEOGRAPHS = (
    r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{F900}-\x{FAFF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B920}-\x{2CEAF}\x{2F800}-\x{2FA1F}]"
)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def string_array(values: list[str]) -> Column:
    """Constant array, as one literal that Spark folds."""
    return F.split(F.lit("\x1f".join(values)), "\x1f")


def string_map(pairs: dict[str, str]) -> Column:
    """Constant map, as one literal that Spark folds."""
    text = "\x1e".join(f"{k}\x1f{v}" for k, v in pairs.items())
    return F.str_to_map(F.lit(text), F.lit("\x1e"), F.lit("\x1f"))


def plain_word(word: str) -> str:
    """A fixed word as :func:`normalize` would give it (for words that are one token)."""
    parts = unicodedata.normalize("NFD", word)
    return "".join(p for p in parts if unicodedata.category(p) != "Mn").lower()


def ascii_word(word: str) -> str:
    """A fixed word as :func:`ascii_fold` would give it."""
    return unicodedata.normalize("NFKD", word).encode("ascii", "ignore").decode().lower()


def _is_ideograph(char: str) -> bool:
    return "一" <= char <= "鿿" or "㐀" <= char <= "䶿" or "豈" <= char <= "﫿"


@lru_cache(maxsize=1)
def _accent_map() -> tuple[str, str]:
    """Characters whose canonical decomposition without marks is one other character."""
    source, target = [], []
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        if 0xD800 <= point <= 0xDFFF or _is_ideograph(char):
            continue
        bare = "".join(
            part for part in unicodedata.normalize("NFD", char) if unicodedata.category(part) != "Mn"
        )
        if len(bare) == 1 and bare != char:
            source.append(char)
            target.append(bare)
    return "".join(source), "".join(target)


@lru_cache(maxsize=1)
def _ascii_map() -> tuple[str, str, dict[str, str]]:
    """Compatibility decompositions to ASCII: one-to-one pairs, and longer expansions."""
    source, target, expanded = [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF:
            continue
        text = unicodedata.normalize("NFKD", chr(point)).encode("ascii", "ignore").decode()
        if len(text) == 1:
            source.append(chr(point))
            target.append(text)
        elif text:
            expanded[chr(point)] = text
    return "".join(source), "".join(target), expanded


def strip(c: Column | str) -> Column:
    """Remove white space of any kind at both ends (``trim`` only knows blanks).

    A pattern for the end would be tried at every blank of a text, so the end is taken off as the beginning
    of the text read backwards, and only of texts that have white space at an end.
    """

    def begun(t: Column) -> Column:
        return F.regexp_replace(t, r"(?U)^\s+", "")

    def stripped(t: Column) -> Column:
        ends = F.concat(F.left(t, F.lit(1)), F.right(t, F.lit(1)))
        return F.when(ends.rlike(r"(?U)\s"), F.reverse(begun(F.reverse(begun(t))))).otherwise(t)

    return let(as_column(c), stripped)


def strip_accents(c: Column | str) -> Column:
    """Decompose and drop combining marks; Korean syllables stay composed."""
    source, target = _accent_map()
    return F.regexp_replace(F.translate(as_column(c), source, target), r"\p{Mn}+", "")


def delete_punctuation(c: Column | str) -> Column:
    """Lower case, every ASCII punctuation character to a blank."""
    return F.regexp_replace(F.lower(as_column(c)), PUNCTUATION, " ")


def ascii_fold(c: Column | str) -> Column:
    """Lower case ASCII rendering, everything else dropped."""
    source, target, expanded = _ascii_map()
    c = as_column(c)
    known = string_map(expanded)
    wide = F.array_join(
        F.transform(F.split(c, ""), lambda char: F.coalesce(known[char], char)), ""
    )
    has_wide = F.char_length(F.translate(c, "".join(expanded), "")) < F.char_length(c)
    spelled = F.when(has_wide, wide).otherwise(c)
    folded = F.regexp_replace(F.translate(spelled, source, target), r"[^\x00-\x7F]", "")
    return F.lower(F.when(c.rlike(r"[^\x00-\x7F]"), folded).otherwise(c))


def _in_ranges(ranges: str) -> frozenset[int]:
    """The code points of ranges written as hexadecimal numbers, ``first-last`` or one alone."""
    limits = [part.split("-") for part in ranges.split()]
    return frozenset(p for first, *last in limits for p in range(int(first, 16), int((last or [first])[0], 16) + 1))


def _class(ranges: str) -> str:
    """The same ranges inside a character class."""
    parts = [[f"\\x{{{limit}}}" for limit in part.split("-")] for part in ranges.split()]
    return "".join("-".join(part) for part in parts)


# Outside of these a character is rare: only texts with one pay for it. Java's tables are not asked there.
RARE = r"[\x{0860}-\x{1DFF}\x{2C00}-\x{10FFFF}]"
PRIVATE = r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]+"


@lru_cache(maxsize=None)
def _bare_map(blank: str) -> tuple[str, str, dict[str, str]]:
    """What becomes of each character: pairs for ``translate`` (deleted ones last, without a partner), and
    the few that become several.

    Characters are decomposed, lose their marks and their capitals; white space and ``blank`` go to a
    blank; controls, format characters and marks go. Only marks and letters of later Unicode versions than the rule's
    are listed; the rest is Python's table.
    """
    late, format_kept = _in_ranges(LATE_MARKS), _in_ranges(LATE_FORMATS)
    pairs, gone, several = {}, [], {}
    for capitals, small in (pair.split(":") for pair in LATE_CAPITALS.split()):
        for i, point in enumerate(sorted(_in_ranges(capitals))):
            pairs[chr(point)] = chr(int(small, 16) + i)
    for point in [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]:
        char, kind = chr(point), unicodedata.category(chr(point))
        if char in "\t\n\r" or kind in ("Zs", "Zl", "Zp"):
            pairs[char] = " "
        elif point in (0xFFFD, 0x1734) or kind == "Cc" or (kind == "Cf" and point not in format_kept) or (kind == "Mn" and point not in late):
            gone.append(char)
        elif 0xAC00 <= point <= 0xD7A3 or point == 0x11938 or kind in ("Cn", "Co"):
            continue  # syllables stay composed
        else:
            parts = unicodedata.normalize("NFD", char)
            bare = "".join(p for p in parts if unicodedata.category(p) != "Mn" or ord(p) in late).lower()
            if len(bare) > 1:
                several[char] = bare
            elif bare != char or char in blank:
                pairs.setdefault(char, " " if bare in blank else bare)
    return "".join([*pairs, *gone]), "".join(pairs.values()), several


def _bare_text(c: Column, blank: str) -> Column:
    """No accents, control characters gone, some characters blank, lower case: one translation.

    Rare characters may also be spelled out, be private ones, which go, or ideographs, which stand alone.
    """
    source, target, several = _bare_map(blank)
    known = string_map(several)
    letters = F.transform(F.split(c, ""), lambda char: F.coalesce(known[char], char))
    spelled = F.when(c.rlike("[" + "".join(several) + "]"), F.array_join(letters, "")).otherwise(c)
    rare = F.regexp_replace(F.translate(spelled, source, target), PRIVATE, "")
    rare = F.regexp_replace(rare, f"({IDEOGRAPHS})", " $1 ")
    return F.when(c.rlike(RARE), rare).otherwise(F.translate(c, source, target))


def _tokens(c: Column, blank: str) -> Column:
    """Runs of word characters and runs of others of the bare text.

    Texts of printable ASCII characters need no table and no translation.
    """
    escaped, word = "".join(f"\\{char}" for char in blank), "a-z0-9" if "_" in blank else "a-z0-9_"
    plain = F.regexp_extract_all(F.lower(c), F.lit(rf"[{word}]+|[^a-z0-9_\s{escaped}]+"), F.lit(0))
    late = _class(LATE_MARKS) + _class(LATE_WORDS)

    def split(word: str) -> Callable[[Column], Column]:
        return lambda text: F.regexp_extract_all(text, F.lit(rf"(?U)[{word}]+|[^{word}\s]+"), F.lit(0))

    bare = _bare_text(c, blank)
    wide = let(bare, lambda text: F.when(text.rlike(RARE), split(r"\w" + late)(text)).otherwise(split(r"\w")(text)))
    return F.when(c.rlike(r"[^\t\n\r\x20-\x7E]"), wide).otherwise(plain)


def normalize(c: Column | str, min_length: int = 0) -> Column:
    """Words and punctuation runs of the bare text, joined by one blank.

    With ``min_length`` shorter tokens go, unless they are a run of digits.
    """
    tokens = let(as_column(c), lambda text: _tokens(text, "<>$"))
    if min_length:
        tokens = F.filter(
            tokens,
            lambda t: (F.char_length(t) > min_length) | F.contains(F.lit("0123456789"), t),
        )
    return F.array_join(tokens, " ")


def normalize_key(c: Column | str, remove_space: bool = True, min_length: int = 0) -> Column:
    """Like :func:`normalize` without punctuation and, by default, without blanks; null gives ''."""
    tokens = let(as_column(c), lambda text: _tokens(text, string.punctuation))
    if min_length:
        tokens = F.filter(tokens, lambda t: F.char_length(t) > min_length)
    joined = F.array_join(tokens, "" if remove_space else " ")
    return F.coalesce(joined, F.lit(""))


def search_text(c: Column | str) -> Column:
    """Lower case, elided French articles removed, accents folded, tokenised."""
    articles = "|".join(ELIDED_ARTICLES)
    return normalize(F.regexp_replace(as_column(c), rf"(?iU)\b({articles})['’]", ""))


def dedup_sort(c: Column | str) -> Column:
    """Distinct non-empty items, sorted."""
    return F.array_sort(F.array_distinct(F.filter(as_column(c), lambda x: x != "")))


def words(c: Column | str, kind: T.DataType) -> Column:
    """All string leaves of a nested value of the given type, in order, joined by blanks.

    Leaves that are not strings, and nulls, count as empty words.
    """
    c = as_column(c)
    if isinstance(kind, T.StringType):
        joined = c
    elif isinstance(kind, T.StructType):
        joined = F.concat_ws(" ", *[words(c[f.name], f.dataType) for f in kind.fields])
    elif isinstance(kind, T.ArrayType):
        joined = F.array_join(F.transform(c, lambda x: words(x, kind.elementType)), " ")
    elif isinstance(kind, T.MapType):
        joined = F.array_join(F.transform(F.map_values(c), lambda x: words(x, kind.valueType)), " ")
    else:
        return F.lit("")
    return F.coalesce(joined, F.lit(""))


def clean_doi(c: Column | str) -> Column:
    """First ``10.`` run up to a blank, lower case, escaped slashes resolved; null if none."""
    text = F.replace(strip(F.lower(as_column(c))), F.lit("%2f"), F.lit("/"))
    found = F.regexp_extract(text, r"10\.[^\n]*?(?= |\z)", 0)
    return F.nullif(strip(found), F.lit(""))


def clean_id(c: Column | str) -> Column:
    """Identifier without ``.0``, lower case, first comma part."""
    text = F.lower(strip(F.replace(as_column(c), F.lit(".0"), F.lit(""))))
    return strip(F.split(text, ",")[0])


def uri_tail(c: Column | str) -> Column:
    """Part after the last slash; empty or null gives ''."""
    return F.coalesce(F.substring_index(as_column(c), "/", -1), F.lit(""))


def id_if_scheme(identifier: Column | str, scheme: Column | str, wanted: str) -> Column:
    """Tail of the identifier when its scheme is the wanted one, else null."""
    return F.when(as_column(scheme) == wanted, uri_tail(identifier))


def file_key(c: Column | str) -> Column:
    """File-safe form of a DOI."""
    return F.translate(as_column(c), "/:*", "_-")


def listify(c: Column | str) -> Column:
    """Text of a list of quoted words to an array; anything else gives an empty array."""
    c = as_column(c)
    listed = F.from_json(c, "array<string>", {"allowSingleQuotes": "true"})
    empty = F.array().cast("array<string>")
    return F.when(c.startswith("["), F.coalesce(listed, empty)).otherwise(empty)
