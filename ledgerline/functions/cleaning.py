"""Column rules that turn the raw ERP text into typed values.

Each rule is a pure ``Column -> Column`` function built from Spark built-ins, so it runs inside
whole-stage codegen.  The rules reproduce the reference engine's text semantics exactly, which
differ from Spark's defaults in a few places:

* ``trim`` there strips the Unicode space separators (category Zs: space, no-break space, the
  U+2000 block, ...) but no tabs or newlines; Spark's ``trim`` strips only U+0020.
* ``\\s`` there is ``[\\t\\n\\f\\r ]`` (no vertical tab); ``$`` matches only at the very end.
* a two-digit year ``yy`` means 1969-2068 there, 2000-2099 in Spark.
* text -> double there accepts surrounding ASCII whitespace, ``inf``/``nan`` and plain decimal
  numbers (digits may be grouped by ``_``); Spark's ``try_cast`` also accepts forms such as
  ``1.5d`` that must stay NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (the reference engine's text semantics, see module docstring).
# The Unicode space separators (category Zs), stripped by the reference's trim.
SPACE_SEPARATORS = " \u00a0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u202f\u205f\u3000"
_WHITESPACE_RUN = r"[\t\n\f\r ]+"
# ASCII blanks a text -> number cast ignores at both ends.
CAST_BLANKS = "\t\n\x0b\f\r "
# Digits may be grouped by single underscores between digits (``1_000``).
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = rf"^[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\z|^(?i)[+-]?(inf|infinity|nan)\z"
_WHOLE = rf"^[+-]?{_DIGITS}\z"
_DMY_SLASH = r"^\d{2}/\d{2}/\d{4}\z"
_YMD_DASH = r"^\d{4}-\d{2}-\d{2}\z"
_DMY_SHORT = r"^\d{2}-\d{2}-\d{2}\z"


def _text(v: Column | str) -> Column:
    c = F.col(v) if isinstance(v, str) else v
    return c.cast("string")


def trim_spaces(v: Column | str) -> Column:
    """``trim``: drop space separators at both ends (not tabs or newlines)."""
    return F.btrim(_text(v), F.lit(SPACE_SEPARATORS))


def cast_text(v: Column | str) -> Column:
    """Text without the blanks that a text -> number cast ignores."""
    return F.btrim(_text(v), F.lit(CAST_BLANKS))


def parse_number(s: Column | str) -> Column:
    """``cast_text`` -> double with the reference's accepted forms; anything else -> NULL."""
    s = F.col(s) if isinstance(s, str) else s
    return F.when(s.rlike(_NUMBER), F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))


def to_double_strict(v: Column | str) -> Column:
    return parse_number(cast_text(v))


def number_text(v: Column | str) -> Column:
    """First half of C1: the text without ``R$`` and spaces, with a point as the decimal mark.

    With a comma in the text, dots can only be thousands separators and the comma is the decimal
    mark; without one the text stays as it is.
    """
    x = trim_spaces(F.replace(F.replace(_text(v), F.lit("R$"), F.lit("")), F.lit(" "), F.lit("")))
    return cast_text(F.when(x.contains(","), F.translate(x, ",.", ".")).otherwise(x))


def to_num(v: Column | str) -> Column:
    """money/number text in Brazilian or plain notation -> double.

    ``89.90`` -> 89.9, ``R$ 1.234,56`` -> 1234.56, ``1.234.567`` -> NULL.  Over a table, prepare the
    text with ``number_text`` in one projection and convert it with ``parse_number`` in the next, so
    that it is made once a value.
    """
    return parse_number(number_text(v))


def parse_date(t: Column | str) -> Column:
    """Second half of C2, over ``trim_spaces``."""
    t = F.col(t) if isinstance(t, str) else t
    yy = F.substring(t, 7, 2)
    century = F.when(yy >= F.lit("69"), F.lit("19")).otherwise(F.lit("20"))
    return (
        F.when(t.rlike(_DMY_SLASH), F.try_to_date(t, "dd/MM/yyyy"))
        .when(t.rlike(_YMD_DASH), F.try_to_date(t, "yyyy-MM-dd"))
        .when(t.rlike(_DMY_SHORT), F.try_to_date(F.concat(F.substring(t, 1, 6), century, yy), "dd-MM-yyyy"))
    )


def to_date_br(v: Column | str) -> Column:
    """Date text -> date, format chosen by the shape of the text, never by trial.

    ``dd/mm/yyyy``, ``yyyy-mm-dd`` or ``dd-mm-yy`` (69-99 -> 19xx, 00-68 -> 20xx); any other
    shape or an impossible date -> NULL.
    """
    return parse_date(trim_spaces(v))


def norm_txt(v: Column | str) -> Column:
    """Trim, collapse whitespace runs to one space, empty -> NULL."""
    return F.nullif(F.regexp_replace(trim_spaces(v), _WHITESPACE_RUN, " "), F.lit(""))


def digits_only(v: Column | str) -> Column:
    """C4: keep the ASCII digits (document numbers such as CNPJ); nothing left -> NULL."""
    return F.nullif(F.regexp_replace(_text(v), r"[^0-9]", ""), F.lit(""))


def flag_yes(v: Column | str) -> Column:
    """``upper(trim(x)) = 'S'``; NULL stays NULL."""
    return F.upper(trim_spaces(v)) == F.lit("S")


def parse_int(s: Column | str) -> Column:
    """``cast_text`` -> int, NULL for bad text or a value out of range.

    Whole numbers are cast directly so large keys keep full precision; a decimal text rounds
    (``12.7`` -> 13), digits may be grouped (``1_000``), and ``inf`` and ``nan`` are no integers.
    """
    s = F.col(s) if isinstance(s, str) else s
    x = parse_number(s)
    rounded = F.round(F.when(F.abs(x) < F.lit(float("inf")), x)).try_cast("int")
    return F.when(s.rlike(_WHOLE), F.replace(s, F.lit("_"), F.lit("")).try_cast("int")).otherwise(rounded)


def strict_int(s: Column | str) -> Column:
    """``parse_int`` that raises on what it can't convert, as the reference's cast does."""
    s = F.col(s) if isinstance(s, str) else s
    bad = F.raise_error(F.concat(F.lit("not an integer: "), s)).cast("int")
    return F.when(s.isNull(), F.lit(None).cast("int")).otherwise(F.coalesce(parse_int(s), bad))


def try_int(v: Column | str) -> Column:
    """Text -> int, NULL for bad text (the converter check's form)."""
    return parse_int(cast_text(v))


def to_int_like_cast(v: Column | str) -> Column:
    """Text -> int; bad text raises (staging's form)."""
    return strict_int(cast_text(v))
