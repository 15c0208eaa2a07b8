"""Text clean-up as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points treated as white space when text is stripped or split.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Latin letters that have no one-letter decomposition.
SPELLED_OUT = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "ø": "o", "Ø": "O",
    "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ı": "i",
}

# Signs that are spelled with ASCII ones.
SYMBOLS = {
    "\u00a0": " ", "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=", "¦": "|", "§": "SS",
    "¨": '"', "©": "(c)", "ª": "a", "«": "<<", "¬": "!", "®": "(r)", "¯": "-", "°": "deg",
    "±": "+-", "²": "2", "³": "3", "´": "'", "µ": "u", "¶": "P", "·": "*", "¸": ",", "¹": "1",
    "º": "o", "»": ">>", "¼": "1/4", "½": "1/2", "¾": "3/4", "¿": "?", "×": "x", "÷": "/",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "‘": "'", "’": "'", "‚": ",", "“": '"',
    "”": '"', "„": ",,", "•": "*", "…": "...", "‹": "<", "›": ">", "€": "EUR", "™": "(tm)",
}


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and their plain letters, by Unicode decomposition."""
    accented, plain = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = "".join(
            c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c)
        )
        if base != letter and len(base) == 1 and base.isascii():
            accented.append(letter)
            plain.append(base)
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _accent_table()


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone only knows the space)."""
    return F.btrim(text, F.lit(WHITESPACE))


def zero_pad(text: Column, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer text is kept and a sign stays in front."""
    signed = F.concat(
        F.substring(text, 1, 1),
        F.lpad(F.substr(text, F.lit(2)), width - 1, "0"),
    )
    return (
        F.when(F.length(text) >= width, text)
        .when(text.startswith("-") | text.startswith("+"), signed)
        .otherwise(F.lpad(text, width, "0"))
    )


def fold_accents(text: Column) -> Column:
    """Replace accented Latin letters and typographic signs by ASCII. Other scripts pass
    unchanged."""
    single = {c: s for c, s in SYMBOLS.items() if len(s) == 1}
    folded = F.translate(
        text, _ACCENTED + "".join(single), _PLAIN + "".join(single.values())
    )
    longer = {c: s for c, s in SYMBOLS.items() if len(s) > 1}
    for letter, spelled in (SPELLED_OUT | longer).items():
        folded = F.replace(folded, F.lit(letter), F.lit(spelled))
    return F.regexp_replace(folded, "[\u0300-\u036f]", "")


def word_count(text: Column) -> Column:
    """Number of pieces between white space; empty text has none."""
    return F.regexp_count(text, F.lit(f"[^{WHITESPACE}]+"))


def zip_code(value: Column) -> Column:
    return zero_pad(strip(value.cast("string")), 5)


def city_name(value: Column) -> Column:
    return fold_accents(strip(F.lower(value)))


def state_code(value: Column) -> Column:
    return strip(F.upper(value))


def identifier(value: Column) -> Column:
    return strip(value.cast("string"))
