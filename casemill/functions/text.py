"""Text expressions. NULL stays NULL unless a function says otherwise."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# every character that counts as white space when a value is trimmed
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Latin letters and signs without a canonical decomposition.
SPELLED_OUT = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O",
    "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L",
    "ħ": "h", "Ħ": "H", "ı": "i", "ŋ": "ng", "Ŋ": "NG", "ĸ": "k",
    "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "--", "…": "...", "€": "EUR",
    "«": "<<", "»": ">>", "¿": "?", "¡": "!", "º": "o", "ª": "a", "°": "deg",
}


# Latin letters with accents, blanks, raised and lowered signs, letter-like signs and number forms,
# ligatures, full-width forms; other scripts stay as they are
BLOCKS = (
    range(0x00A0, 0x0250), range(0x1E00, 0x1F00), range(0x2000, 0x2010), range(0x2070, 0x20A0),
    range(0x2100, 0x2190), range(0xFB00, 0xFB07), range(0xFF01, 0xFF5F),
)


def _accent_table() -> tuple[str, str, dict[str, str]]:
    """Characters to map one to one, their targets, and those with longer targets."""
    table = dict(SPELLED_OUT)
    for char in map(chr, [c for block in BLOCKS for c in block]):
        decomposed = unicodedata.normalize("NFKD", char)
        plain = "".join(c for c in decomposed if not unicodedata.combining(c))
        if plain and plain != char and plain.isascii():
            table.setdefault(char, plain)
    single = {k: v for k, v in table.items() if len(v) == 1}
    longer = {k: v for k, v in table.items() if len(v) > 1}
    return "".join(single), "".join(single.values()), longer


_FROM, _TO, _LONGER = _accent_table()
# letters that may need more than one: a few of Latin-1 and, as one range, all beyond it
_MAY_SPELL = "[" + "".join(k for k in _LONGER if k <= "\xff") + "\u0100-\uffff]"
# translate() deletes what has no counterpart: loose combining marks go away
_MARKS = "".join(map(chr, range(0x0300, 0x0370)))


def strip_accents(c: Column) -> Column:
    """Latin text without accents. Pure ASCII values skip the table."""
    plain = F.translate(c, _FROM + _MARKS, _TO)
    pairs = F.str_to_map(
        F.lit("\x1e".join(f"{k}\x1f{v}" for k, v in _LONGER.items())), F.lit("\x1e"), F.lit("\x1f")
    )
    # only the characters that occur are looked up
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(f"({_MAY_SPELL})"), F.lit(1)))
    spelled = F.aggregate(found, plain, lambda t, e: F.replace(t, e, F.coalesce(F.try_element_at(pairs, e), e)))
    return (
        F.when(F.octet_length(c) == F.char_length(c), c)
        .when(F.rlike(c, F.lit(_MAY_SPELL)), spelled)
        .otherwise(plain)
    )


def strip(c: Column) -> Column:
    """Trim every kind of white space on both ends."""
    return F.trim(c, F.lit(BLANKS))


def normalize_text(c: Column) -> Column:
    """No accents, trimmed, lower case; NULL becomes the empty string."""
    return F.coalesce(F.lower(strip(strip_accents(c))), F.lit(""))


def normalize_or_null(c: Column) -> Column:
    """X1 for columns that must keep NULL apart from the empty string."""
    return F.lower(strip(strip_accents(c)))


def trim_lower(c: Column) -> Column:
    """Trimmed, lower case, accents kept."""
    return F.lower(strip(c))


def title_case(c: Column) -> Column:
    """A capital after every non-letter, not only after a blank.

    ``initcap`` knows simple blanks only, so a marked one is put before each letter that
    follows any other non-letter, and taken out again.
    """
    marked = F.regexp_replace(c, r"([^\p{L} ])(\p{L})", "$1\u0001 $2")
    return F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))


def before_first(c: Column, separator: str) -> Column:
    """The text before the first separator, or all of it."""
    return F.substring_index(c, separator, 1)


def account_of(c: Column) -> Column:
    """The login part of a mail-like user name."""
    return before_first(c, "@")


def top_service(c: Column) -> Column:
    """The first level of a service path."""
    return before_first(c, " > ")


def last_line(c: Column) -> Column:
    """The text after the last line break."""
    return F.substring_index(c, "\n", -1)


def remove_literal(c: Column, *pieces: str) -> Column:
    """Take the pieces out wherever they stand."""
    for piece in pieces:
        c = F.replace(c, F.lit(piece), F.lit(""))
    return c


# white space in patterns: the Latin-1 blanks one by one, which match several times faster than
# ranges or the Unicode switch
SPACE = r"[ \t\n\u000b\f\r\u001c\u001d\u001e\u001f\u0085\u00a0]"
_WORD = SPACE.replace("[", "[^")
_WIDE = "".join(b for b in BLANKS if b > "\xff")
_UNEVEN = f"  |{SPACE.replace('[ ', '[')}"
_TWO = f"{_WORD}+{SPACE}+{_WORD}+"
# six words | three and more | two: the part before and the part after the turn
_TURN = (
    f"^{SPACE}*(?:({_TWO}{SPACE}+{_TWO}){SPACE}+({_TWO})"
    f"|({_TWO}){SPACE}+({_WORD}(?s:.*?))|({_WORD}+){SPACE}+({_WORD}+)){SPACE}*$"
)


def reorder_name(c: Column, keep_as_is: Iterable[str] = ()) -> Column:
    """Family names first -> given names first, by the number of words.

    Six words: the last two come first; three and more: the first two go last; two are
    swapped. Blanks between words become single ones. ``keep_as_is`` lists names (lower case)
    that are already right; it does not hold for names of two or six words.
    """
    kept = [known for known in keep_as_is if len(known.split()) not in (2, 6)]

    def turned(text: Column) -> Column:
        several = F.rlike(text, F.lit(f"{_WORD}{SPACE}+{_WORD}"))
        if kept:
            several &= ~F.lower(c).isin(kept)
        name = F.regexp_replace(text, _TURN, "$2$4$6 $1$3$5")
        uneven = F.rlike(text, F.lit(_UNEVEN))
        even = F.when(uneven, F.regexp_replace(name, f"{SPACE}+", " ")).otherwise(name)
        return F.when(several, even).otherwise(c)

    # wide blanks are rare: only names with a character of their range pay for making them simple
    simple = F.translate(c, _WIDE, " " * len(_WIDE))
    wide = F.rlike(c, F.lit(f"[{min(_WIDE)}-{max(_WIDE)}]"))
    return F.when(wide, turned(simple)).otherwise(turned(c))


def contains_text(c: Column, piece: str) -> Column:
    """Case-sensitive containment; NULL does not contain anything."""
    return F.coalesce(F.contains(c, F.lit(piece)), F.lit(False))


def lookup_key(c: Column, lower: bool = True) -> Column:
    """A lookup key, NULL when nothing is left after trimming."""
    key = trim_lower(c) if lower else strip(c)
    return F.nullif(key, F.lit(""))


def remap(c: Column, mapping: Mapping[str, str]) -> Column:
    """Replace whole values in a single pass; the rest stays."""
    if not mapping:
        return c
    return F.coalesce(*[F.when(c == old, F.lit(new)) for old, new in mapping.items()], c)


def only_digits(c: Column) -> Column:
    """the trimmed text is a run of decimal digits; NULL is not."""
    return F.coalesce(F.rlike(strip(c), F.lit(r"^\p{Nd}+$")), F.lit(False))
