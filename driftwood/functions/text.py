"""Text expressions: numeric parsing, encoding repair, token similarity.

All functions return :class:`pyspark.sql.Column` built from built-in
expressions, so they stay inside whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spelling of a floating-point number, matching
# what a Python ``float(text)`` call accepts except underscores in digits
# (null by choice) and excluding the ``d``/``f`` suffixes that Spark casts
# would otherwise accept.
FLOAT_TEXT_PATTERN = (
    r"(?i)^\s*[-+]?((\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?|nan|inf|infinity)\s*$"
)
# Characters that survive a Latin-1 round trip: only such text can be the
# Latin-1 reading of UTF-8 bytes.
LATIN1_ONLY_PATTERN = r"^[\x00-\xFF]*$"
# Unicode-aware whitespace split, equal to Python's ``str.split()``.
WHITESPACE_PATTERN = r"(?U)\s+"
NON_NUMERIC_PATTERN = r"[^0-9.]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_double(c) -> Column:
    """Text to double; text that is not a number becomes null."""
    c = _col(c)
    return F.when(c.rlike(FLOAT_TEXT_PATTERN), c.try_cast("double"))


def is_non_numeric(c) -> Column:
    """True where the text holds any character besides digits and '.' (C6)."""
    return _col(c).rlike(NON_NUMERIC_PATTERN)


# The characters Windows-1252 has where Latin-1 has the control
# characters U+0080 to U+009F, and those control characters.
CP1252_BYTES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
CP1252_CHARS = bytes(CP1252_BYTES).decode("cp1252")
CP1252_CONTROLS = "".join(map(chr, CP1252_BYTES))


def _bound(c: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def _ascii(c: Column) -> Column:
    """Whether every character takes one byte: such text is damaged nowhere."""
    return F.octet_length(c) == F.length(c)


def _strict_repair(c: Column) -> Column:
    """The text whose UTF-8 bytes were read as Latin-1; null if it is not such."""
    fits = c.rlike(LATIN1_ONLY_PATTERN)
    safe = F.when(fits, c).otherwise(F.lit(""))
    return F.when(fits, F.try_validate_utf8(F.encode(safe, "ISO-8859-1").cast("string")))


def repair_mojibake(c) -> Column:
    """Undo UTF-8 bytes that were decoded as Latin-1 or Windows-1252.

    Text whose characters all fit in Latin-1 is re-encoded and decoded as
    UTF-8; if the bytes are not valid UTF-8 the text was clean and is kept.
    Where that does not apply because of characters that only Windows-1252
    has, those are first put back to the bytes they stand for.  Text that is
    damaged in neither way is kept unchanged (the guard also keeps ``encode``
    from raising under ANSI).
    """
    c = _col(c)
    return F.when(_ascii(c), c).otherwise(
        F.coalesce(_strict_repair(c), _strict_repair(F.translate(c, CP1252_CHARS, CP1252_CONTROLS)), c))


# A damaged character is a run of characters that stand for the bytes of one
# UTF-8 sequence: a first one that says how many follow, and these.
_FIRST = "\u00C2-\u00F4"
_NEXT = "\u0080-\u00BF" + CP1252_CHARS
_UNIT = f"[\u00C2-\u00DF][{_NEXT}]|[\u00E0-\u00EF][{_NEXT}]{{2}}|[\u00F0-\u00F4][{_NEXT}]{{3}}"
# Characters that may well follow an accented letter in clean text: no-break
# space, closing quotes, dashes, marks, superscripts, and letters.
_COMMON = "\u00A0\u00AB\u00BB\u00A9\u00AE\u00B0\u00B7\u00AA\u00BA\u00B2\u00B3\u00B9\u2018\u2019\u201C\u201D\u2026\u2013\u2014\u2122" \
          "\u2039\u203A\u0160\u0152\u017D\u0161\u0153\u017E\u0178\u0192"
_RARE = f"[{_NEXT}&&[^{_COMMON}]]"
# What shows that a stretch is damaged: a sequence that begins as those of
# western accented letters and signs do, or that holds a rare follower.
_EVIDENT = f"[\u00C2\u00C3][{_NEXT}]|[\u00C4-\u00DF]{_RARE}" \
           f"|[\u00E0-\u00EF](?:{_RARE}[{_NEXT}]|[{_NEXT}]{_RARE})" \
           f"|[\u00F0-\u00F4](?:{_RARE}[{_NEXT}]{{2}}|[{_NEXT}]{_RARE}[{_NEXT}]|[{_NEXT}]{{2}}{_RARE})"
# The range test ahead of a search is all that most characters meet.
_DAMAGED = f"(?=[{_FIRST}])(?:{_EVIDENT})"
_STRETCHES = f"(?s)[\\x00-\\x7F]++|[{_FIRST}{_NEXT}]++|[^\\x00-\\x7F{_FIRST}{_NEXT}]++"
_UNITS = f"(?s){_UNIT}|."


def _repair_once(c: Column) -> Column:
    def unit(u: Column) -> Column:
        bytes_of = F.translate(u, CP1252_CHARS, CP1252_CONTROLS)
        return F.when(F.length(u) > 1, F.coalesce(_bound(bytes_of, _strict_repair), u)).otherwise(u)

    def stretch(s: Column) -> Column:
        units = F.regexp_extract_all(s, F.lit(_UNITS), F.lit(0))
        return F.when(~_ascii(s) & s.rlike(_DAMAGED), F.array_join(F.transform(units, unit), "")).otherwise(s)

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_STRETCHES), F.lit(0)), stretch), "")


def repair_segments(c) -> Column:
    """Undo wrong decoding inside a text that is damaged only in part.

    Stretches of characters that can stand for bytes are looked at one by
    one.  In a stretch that shows damage every run that is a valid UTF-8
    sequence, read as Latin-1 or Windows-1252, becomes its character; all
    else stays, so clean characters beside a damaged word block nothing.  A
    stretch of only such sequences as clean text may hold (an accented
    letter before a no-break space, a closing quote, …) is left alone.

    Text damaged several times is repaired as often: a character that comes
    out of k repairs was 2**k characters, so log2(length) rounds reach the
    fixpoint.  They end with the first that changes nothing or leaves no
    evident damage.  Text without evident damage costs one pattern search,
    text of ASCII characters alone none.
    """
    def repaired(text: Column) -> Column:
        rounds = F.greatest(F.lit(1), F.ceil(F.log2(F.length(text) + F.lit(1.0)))).cast("int")

        def again(state: Column, _) -> Column:
            return F.when(state["go"], _bound(_repair_once(state["text"]), lambda new: F.struct(
                new.alias("text"), ((new != state["text"]) & new.rlike(_DAMAGED)).alias("go")))).otherwise(state)

        return F.when(text.rlike(_DAMAGED), F.aggregate(
            F.sequence(F.lit(1), rounds), F.struct(text.alias("text"), F.lit(True).alias("go")), again,
            lambda state: state["text"])).otherwise(text)

    c = _col(c)
    return F.when(_ascii(c), c).otherwise(_bound(c, repaired))


def repair_text(c) -> Column:
    """Encoding repair of a whole text, then of its parts."""
    c = _col(c)
    return F.when(_ascii(c), c).otherwise(repair_segments(repair_mojibake(c)))


def damage_as_latin1(c) -> Column:
    """Read the UTF-8 bytes of the text as Latin-1 (the damage X2 repairs)."""
    return F.decode(F.encode(_col(c), "UTF-8"), "ISO-8859-1")


def damage_as_cp1252(c) -> Column:
    """Read the UTF-8 bytes of the text as Windows-1252 (bytes without a
    character there become control characters, as in browsers)."""
    return F.translate(damage_as_latin1(c), CP1252_CONTROLS, CP1252_CHARS)


def plain_quotes(c) -> Column:
    """Typographic quotes as plain ones."""
    single, double = "\u2018\u2019\u201a\u201b", "\u201c\u201d\u201e\u201f"
    return F.translate(_col(c), single + double, "'" * 4 + '"' * 4)


def unix_lines(c) -> Column:
    """Line breaks of any kind as line feeds."""
    return F.regexp_replace(_col(c), "\r\n|\r|\u0085|\u2028|\u2029", "\n")


def without_controls(c) -> Column:
    """Control characters other than tab, line feed and carriage return removed."""
    return F.regexp_replace(_col(c), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def tokens(c) -> Column:
    """Distinct lowercase whitespace tokens, empty strings removed."""
    parts = F.split(F.lower(_col(c)), WHITESPACE_PATTERN)
    return F.array_distinct(F.filter(parts, lambda t: t != F.lit("")))


def jaccard_of_sets(a: Column, b: Column) -> Column:
    """|a ∩ b| / |a ∪ b| for token arrays; 0 when the union is empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(a, b)) / union)


def token_jaccard(a, b) -> Column:
    """Token-set Jaccard similarity of two strings; null on either side → 0."""
    a, b = _col(a), _col(b)
    return F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(
        jaccard_of_sets(tokens(a), tokens(b)))
