"""Name normalization as one native expression."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _ascii_forms() -> dict[str, str]:
    """Every non-ASCII character whose compatibility decomposition holds ASCII, with that ASCII part."""
    forms = {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        decomposed = unicodedata.normalize("NFKD", char)
        if decomposed != char:
            ascii_part = decomposed.encode("ascii", "ignore").decode("ascii")
            if ascii_part:
                forms[char] = ascii_part
    return forms


@cache
def _letter_table() -> tuple[str, str]:
    singles = [(c, a) for c, a in _ascii_forms().items() if len(a) == 1]
    return "".join(c for c, _ in singles), "".join(a for _, a in singles)


@cache
def _expansion_class(max_gap: int = 1) -> str:
    """Regex class of the characters that become several ASCII characters.

    A larger ``max_gap`` joins neighbouring ranges: the class then holds other characters as well,
    but is much cheaper to test.
    """
    codes = sorted(ord(c) for c, a in _ascii_forms().items() if len(a) > 1)
    spans: list[list[int]] = []
    for code in codes:
        if spans and code - spans[-1][1] <= max_gap:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in spans) + "]"


def _expand_ligatures(text: Column) -> Column:
    """Replace characters such as U+FB01 or U+2026 by their several ASCII characters."""
    chars = _expansion_class()
    expansions = "\n".join(f"{char}\t{part}" for char, part in _ascii_forms().items() if len(part) > 1)
    table = F.str_to_map(F.lit(expansions), F.lit("\n"), F.lit("\t"))

    def expand_first(piece: Column) -> Column:
        first = F.substring(piece, 1, 1)
        return F.concat(F.coalesce(F.try_element_at(table, first), first), F.substr(piece, F.lit(2)))

    # Only the first character of a piece can need expansion: the split is right before each of them.
    return F.array_join(F.transform(F.split(text, f"(?={chars})"), expand_first), "")


def normalize_name(name: Column, *, strict: bool = False) -> Column:
    """Lower case, hyphens to blanks, accents removed, other non-ASCII dropped; NULL stays NULL.

    ``strict`` also turns apostrophes into blanks and drops surrounding double quotes, so that
    names the lookup tables spell in these ways match too.
    """
    source, target = _letter_table()
    lowered = F.replace(F.lower(name), F.lit("-"), F.lit(" "))
    # The costly steps run only on rows that need them. Both tests look at the text as it came, so that
    # it is lowered once: lowering makes no ASCII text non-ASCII and adds no character to be expanded.
    only_ascii = F.octet_length(name) == F.char_length(name)
    expand = name.rlike(_expansion_class(max_gap=100))
    letters = F.translate(F.when(expand, _expand_ligatures(lowered)).otherwise(lowered), source, target)
    text = F.when(only_ascii, lowered).otherwise(F.regexp_replace(letters, r"[^\x00-\x7F]", ""))
    if strict:
        text = F.translate(F.btrim(text, F.lit('"')), "'", " ")
    return text
