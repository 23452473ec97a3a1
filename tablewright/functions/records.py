"""Text of the form k1=v1, k2=v2, ... whose keys are known.

One pass over the text finds the known keys at brace depth zero, in any order and with any of them missing. What stands
between two of them is the value of the first, so values may hold commas, equals signs and braced records with keys
of the same names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEY, _VALUE = "\u0001", "\u0002"
# Braces up to three levels deep; the bound on entries keeps the pattern from running out of stack on odd texts.
_FLAT = r"\{[^{}]*+\}"
_INNER = rf"\{{(?:[^{{}}]++|{_FLAT}){{0,500}}+\}}"
_BRACED = rf"\{{(?:[^{{}}]++|{_INNER}){{0,500}}+\}}"


def _cut(text: Column, braced: str, key: str) -> Column:
    """What stands in front of the first key, then each key with its value."""
    # Braced texts match first and stay as they are: the marks behind them, without a key, are taken out again.
    marked = F.regexp_replace(F.concat(F.lit(", "), text), F.lit(f"({braced})|, ({key})="), F.lit(f"$1{_KEY}$2{_VALUE}"))
    return F.split(F.replace(marked, F.lit(_KEY + _VALUE), F.lit("")), _KEY)


def _first(found: Column, mark: str) -> Column:
    return F.get(F.filter(found, lambda p: F.startswith(p, F.lit(mark))), F.lit(0))


def pieces(text: Column) -> Column:
    """The text cut at every word that may be a key: cheap, and all that a record with its keys in the usual order needs."""
    return _cut(text, _FLAT, r"\w++")


def in_order(text: Column, found: Column, keys: tuple[str, ...]) -> Column:
    """From the pieces of a text: what no key covers, then the piece of each key, NULL where the key is absent.

    Pieces that are just the keys in order stay as they are; any other text is cut again, at the keys alone. Of a key that
    comes twice the first counts. Unknown keys belong to the value they follow.
    """
    usual = F.size(found) == len(keys) + 1
    for place, key in enumerate(keys):
        usual = usual & F.startswith(F.get(found, F.lit(place + 1)), F.lit(key + _VALUE))
    known = "|".join(re.escape(k) for k in sorted(keys, key=len, reverse=True))
    # One element, so that the cut is made once for all keys.
    again = F.transform(F.array(_cut(text, _BRACED, known)), lambda cut: F.array(F.get(cut, F.lit(0)), *[_first(cut, k + _VALUE) for k in keys]))
    return F.when(usual, found).when(text.isNotNull(), F.get(again, F.lit(0)))


def value_at(ordered: Column, keys: tuple[str, ...], key: str) -> Column:
    """The value of a key of pieces in order, NULL where it is absent."""
    return F.substring(F.get(ordered, F.lit(keys.index(key) + 1)), F.lit(len(key) + len(_VALUE) + 1), F.lit(1 << 30))


def rejected(text: Column, found: Column) -> Column:
    """The text where it does not begin with a known key, else NULL. Empty text is not rejected."""
    return F.when((F.trim(text) != "") & (F.get(found, F.lit(0)) != ""), text)


def unbraced(text: Column, opening: str = "{", closing: str = "}") -> Column:
    """Text without the braces around it; the braces inside stay."""
    inner = F.substring(text, F.lit(len(opening) + 1), F.length(text) - F.lit(len(opening) + len(closing)))
    return F.when(F.startswith(text, F.lit(opening)) & F.endswith(text, F.lit(closing)), inner).otherwise(text)


def tidy(text: Column) -> Column:
    """Quotes, tabs and escaped spaces that upset later text formats."""
    plain = F.replace(text, F.lit('=",'), F.lit("=,"))
    plain = F.replace(plain, F.lit('"'), F.lit("''"))
    plain = F.replace(plain, F.lit("\t"), F.lit(""))
    return F.replace(plain, F.lit("\\ "), F.lit(" "))
