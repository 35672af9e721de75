"""ASCII-safe text for path components and keys, without any Python in the tasks.

The rule is: compatibility decomposition (NFKD), ``ß`` to ``ss``, path-unsafe
characters to ``_``, everything else that is not ASCII dropped, runs of ``_``
collapsed and trimmed; null and empty results become ``no_value``.

Decomposition followed by dropping what is not ASCII treats every character on
its own, so all but the last step is a fixed map from one character to a short
ASCII string. The map follows by rule from the Unicode character database, and
``translate`` applies it in the JVM. Characters that turn into two or more
(``½``, ``ﬁ``, ``ß``) take a detour: ``translate`` gives each a stand-in from a
private-use block, and only values that hold something not yet ASCII are split
at the stand-ins and expanded.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NO_VALUE = "no_value"
UNSAFE = " /\\:*?\"<>|&%#@!~`+=[]{}()"
SHARP_S = "ß"

_STAND_IN = 0xF0000  # first code point of a private-use plane


@lru_cache(maxsize=1)
def _safe_map() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that become one safe ASCII character, and those that become more."""
    safe = str.maketrans(dict.fromkeys(UNSAFE, "_"))
    one, many = dict.fromkeys(UNSAFE, "_"), {SHARP_S: "ss"}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.decomposition(char):
            plain = "".join(c for c in unicodedata.normalize("NFKD", char) if c < "\x80")
            if len(plain) == 1:
                one[char] = plain.translate(safe)
            elif plain:
                many[char] = plain.translate(safe)
    return one, many


def _to_safe_ascii(text: Column) -> Column:
    one, many = _safe_map()
    stand_ins = [chr(_STAND_IN + i) for i in range(len(many))]
    # Stand-ins that occur in the input have no counterpart in the second
    # string, so translate deletes them, as it should: they are not ASCII.
    mapped = F.translate(
        text,
        "".join(one) + "".join(many) + "".join(stand_ins),
        "".join(one.values()) + "".join(stand_ins),
    )
    block = f"[\\x{{{_STAND_IN:X}}}-\\x{{{_STAND_IN + len(many) - 1:X}}}]"
    # One literal that the optimizer splits once, instead of one per entry.
    table = F.split(F.lit(";".join(many.values())), ";")

    def expand(piece: Column) -> Column:
        head = F.get(table, F.ascii(piece) - _STAND_IN)  # null unless a stand-in
        return F.coalesce(F.concat(head, F.substring(piece, 2, 2**31 - 1)), piece)

    expanded = F.array_join(F.transform(F.split(mapped, f"(?={block})"), expand), "")
    # Equal lengths in bytes and characters: ASCII, the case for most values.
    return F.when(F.octet_length(mapped) == F.length(mapped), mapped).otherwise(
        F.regexp_replace(expanded, "[^\\x00-\\x7F]+", "")
    )


def sanitize(c: Column | str) -> Column:
    """``c`` as ASCII text that is safe as a path component; never null or empty."""
    safe = _to_safe_ascii((F.col(c) if isinstance(c, str) else c).cast("string"))
    single = F.when(F.contains(safe, F.lit("__")), F.regexp_replace(safe, "__+", "_")).otherwise(safe)
    trimmed = F.btrim(single, F.lit("_"))
    return F.coalesce(
        F.when(trimmed.isNull() | (trimmed == ""), NO_VALUE).otherwise(trimmed), F.lit(NO_VALUE)
    )
