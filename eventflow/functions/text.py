"""Column helpers for text: normalisation, rule matching, label parsing.

All helpers return Spark ``Column`` expressions (JVM-side, codegen-able); no
Python runs per row.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# Keyword rules of the label-set builder (weak labels), as regex text.
COMMUNITY_KEYWORDS = (
    r"(festival|parade|market|farmers|community|workshop|class|volunteer|"
    r"fundraiser|family|youth|meetup|open house|concert|perdidopalooza|library|"
    r"park|veterans|food truck|gallery|art\\b|craft\\b)"
)
NON_COMMUNITY_KEYWORDS = (
    r"(ribbon cutting|board meeting|committee|webinar|sponsor|chamber members|"
    r"leads? group|business after hours|b2b|networking)"
)
# Venue flags over the lower-cased location (name -> regex).
VENUE_PATTERNS = {
    "venue_library": r"\blibrary\b",
    "venue_park": r"\bpark\b",
    "venue_church": r"\bchurch\b",
    "venue_museum": r"\bmuseum\b|gallery",
}
# Label values accepted as valid.
VALID_LABELS = ("0", "1")
# ---------------------------------------------------------------------------


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: drop leading and trailing Unicode whitespace."""
    return F.regexp_replace(col_of(c), r"(?U)^\s+|\s+$", "")


def as_text(c) -> Column:
    """Value as text, null as empty string (``str(x or "")``)."""
    return F.coalesce(col_of(c).cast("string"), F.lit(""))


def norm_url(c) -> Column:
    """Trim, cut from the first ``?`` or ``#``, drop all trailing ``/``."""
    u = py_strip(as_text(c))
    u = F.regexp_replace(u, r"(?d)[?#].*$", "")  # (?d): only a line feed ends a line
    return F.regexp_replace(u, r"/+$", "")


def norm_str(c) -> Column:
    """Lower, collapse whitespace, trim, then delete chars outside [a-z0-9 ].

    The deletion runs last, so ``"a - b"`` becomes ``"a  b"`` (two spaces).
    """
    s = F.regexp_replace(F.lower(as_text(c)), r"(?U)\s+", " ")
    s = F.trim(s)
    return F.regexp_replace(s, r"[^a-z0-9 ]+", "")


def title_desc_text(title, desc, lower: bool = False) -> Column:
    """``coalesce(title,'') || ' ' || coalesce(desc,'')``."""
    t = F.concat(as_text(title), F.lit(" "), as_text(desc))
    return F.lower(t) if lower else t


def flatten_category(c, sep: str = ";") -> Column:
    """Join list items dropping null and empty; scalars pass unchanged."""
    return F.array_join(F.filter(col_of(c), lambda x: x.isNotNull() & (x != F.lit(""))), sep)


def four_field_text(title, desc, loc, category) -> Column:
    """The four fields joined by one space; nulls skipped, empties kept."""
    return F.concat_ws(" ", col_of(title), col_of(desc), col_of(loc), col_of(category))


def weak_label_expr(text, pos: str = COMMUNITY_KEYWORDS,
                    neg: str = NON_COMMUNITY_KEYWORDS) -> Column:
    """Negative rule wins, then positive, else null (substring regex search)."""
    t = col_of(text)
    return (F.when(t.rlike(neg), F.lit(0))
            .when(t.rlike(pos), F.lit(1))
            .otherwise(F.lit(None).cast("int")))


def _replace_first_dot0(s: Column) -> Column:
    # str.replace('.0', '', 1): remove the first occurrence only
    return F.regexp_replace(s, r"(?s)^(.*?)\.0", "$1")


def label_text(c) -> Column:
    """Label as pandas renders it with ``astype(str)``: null never matches."""
    return col_of(c).cast("string")


def parse_label(c, variant: str = "fill") -> Column:
    """Parse a 0/1 label that may arrive as int, float text or padded text.

    variants
      ``fill``    first ``.0`` removed, whitespace stripped (series fill)
      ``mask``    first ``.0`` removed, no strip (the fill's row mask)
      ``all_dot0`` every ``.0`` removed, no strip (trainer's labelled mask)
      ``strict``  exact ``0``/``1`` only (trainer's optional propagation)
    Returns a nullable int.
    """
    s = label_text(c)
    if variant == "fill":
        s = py_strip(_replace_first_dot0(s))
    elif variant == "mask":
        s = _replace_first_dot0(s)
    elif variant == "all_dot0":
        s = F.replace(s, F.lit(".0"), F.lit(""))
    elif variant != "strict":
        raise ValueError(f"unknown label variant {variant!r}")
    return F.when(s.isin(*VALID_LABELS), s.cast("int"))


def venue_flags(loc, patterns: dict | None = None) -> dict:
    """E5: name -> 0/1 int column over the lower-cased location."""
    low = F.lower(as_text(loc))
    return {name: low.rlike("(?U)" + rx).cast("int") for name, rx in (patterns or VENUE_PATTERNS).items()}


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str, list[tuple[str, str]]]:
    """Accent folding by rule from Unicode NFKD, for every character of the
    basic plane: (characters with one other base character, those characters,
    [(character, text)] where the decomposition has several or none). Hangul
    syllables, which NFKD takes apart by arithmetic, follow the same rule."""
    src, dst, longer = [], [], []
    for cp in range(0x80, 0x10000):
        if 0xD800 <= cp < 0xE000:
            continue
        ch = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if base == ch or unicodedata.combining(ch):
            continue
        if len(base) == 1:
            src.append(ch)
            dst.append(base)
        else:
            longer.append((ch, base))
    return "".join(src), "".join(dst), longer


@lru_cache(maxsize=1)
def _long_folds() -> tuple[str, dict]:
    """(regex class of the characters that fold to several, character -> text)."""
    longer = dict(_accent_table()[2])
    points = sorted(map(ord, longer))
    runs, lo = [], points[0]
    for a, b in zip(points, points[1:] + [None]):
        if b != a + 1:
            runs.append(f"\\x{{{lo:X}}}-\\x{{{a:X}}}")
            lo = b
    # the first test spares nearly every character the walk through all runs
    return f"[[^\\x{{0}}-\\x{{{points[0] - 1:X}}}]&&[" + "".join(runs) + "]]", longer


def strip_accents(c) -> Column:
    """Fold every character to its compatibility decomposition without
    combining marks. One-to-one cases are one ``translate``; texts that hold a
    ligature, fraction or the like are rebuilt character by character."""
    src, dst, _ = _accent_table()
    many, longer = _long_folds()
    folded = F.translate(col_of(c), src, dst)
    table = F.create_map(*[F.lit(x) for kv in longer.items() if not 0xAC00 <= ord(kv[0]) < 0xD7A4 for x in kv])
    # Hangul: lead, vowel and tail from the syllable's number
    point = lambda ch: F.conv(F.hex(F.encode(ch, "UTF-16BE")), 16, 10).cast("int")
    letter = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")

    def hangul(ch):
        n = point(ch) - F.lit(0xAC00)
        tail = n % 28
        return F.concat(letter((F.lit(0x1100) + F.floor(n / 588)).cast("int")), letter((F.lit(0x1161) + F.floor((n % 588) / 28)).cast("int")),
                        F.when(tail > 0, letter((F.lit(0x11A7) + tail).cast("int"))).otherwise(F.lit("")))

    rebuilt = F.array_join(F.transform(F.split(folded, ""), lambda ch: F.when(ch.rlike(r"^[\x{AC00}-\x{D7A3}]$"), hangul(ch))
                                       .otherwise(F.coalesce(F.try_element_at(table, ch), ch))), "")
    folded = F.when(folded.rlike(many), rebuilt).otherwise(folded)
    return F.regexp_replace(folded, r"\p{Mn}", "")


# Word token: two or more letters, digits or underscores (Python's \w set).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tokens(text, pattern: str = TOKEN_PATTERN) -> Column:
    """I3 unigrams: word tokens of two or more word characters."""
    return F.regexp_extract_all(col_of(text), F.lit(pattern), 0)


def with_bigrams(toks) -> Column:
    """Unigrams followed by adjacent bigrams joined by one space."""
    t = col_of(toks)
    bigrams = F.filter(
        F.zip_with(t, F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(1))),
                   lambda a, b: F.concat(a, F.lit(" "), b)),
        lambda x: x.isNotNull())
    return F.concat(t, F.when(F.size(t) > 1, bigrams).otherwise(F.array().cast("array<string>")))
