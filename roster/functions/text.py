"""Cell cleaning as native column expressions."""

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points treated as white space.
WHITESPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)

# The same 29 code points, with the comma and the full stop, as a Java character class.
_NAME_GAP = r"(?U)[,.\s\x1c-\x1f]+"

# The spreadsheet form ="..." of which only the inside is kept; a lone =" counts as empty.
_WRAPPED = r'(?s)\A="(?:(.*)")?\z'

_PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))


def clean_cell(c: Column) -> Column:
    """Strip a cell and unwrap the spreadsheet form ``="..."``; NULL becomes ''.

    What was inside the quotes is kept as it is, blanks included.
    """
    return _strip_and_unwrap(trimmed(c))


def clean_trimmed_compact(cell: Column) -> Column:
    """``clean_cell`` of a trimmed cell, for use on many cells of a row.

    What settles nearly every cell is compiled into the stage. Only exotic white space goes through a
    lambda, which keeps its longer code out of the generated method.
    """
    rare = F.get(F.transform(F.array(cell), _strip_exotic), F.lit(0))
    return _settled(cell, rare)


def trimmed(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def _strip_and_unwrap(cell: Column) -> Column:
    return _settled(cell, _strip_exotic(cell))


def _strip_exotic(cell: Column) -> Column:
    return F.regexp_replace(F.btrim(cell, F.lit(WHITESPACE)), _WRAPPED, "$1")


def _settled(cell: Column, rare: Column) -> Column:
    """The rest of the cleaning, after a plain trim; ``rare`` is for what is not settled here.

    Nearly every cell is settled by fast native functions: it is wrapped, or it begins and ends with
    a printable ASCII character. Only the others, with exotic white space or letters at an end, are
    stripped of every kind of white space first. All steps are linear in the length of the cell.
    """
    ends = [F.left(cell, F.lit(1)), F.right(cell, F.lit(1))]
    inside = F.substr(cell, F.lit(3), F.greatest(F.length(cell) - 3, F.lit(0)))
    return (
        F.when(cell.startswith('="') & cell.endswith('"'), inside)
        .when(F.lit(_PRINTABLE).contains(ends[0]) & F.lit(_PRINTABLE).contains(ends[1]), cell)
        .otherwise(rare)
    )


def upper_cell(c: Column) -> Column:
    return F.upper(clean_cell(c))


def clean_name_part(c: Column) -> Column:
    """Commas, full stops and runs of white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(c, _NAME_GAP, " "))


def join_parts(*parts: Column) -> Column:
    """Join the non-empty parts by one blank."""
    return F.concat_ws(" ", *[F.nullif(part, F.lit("")) for part in parts])


def full_name(first: Column, middle: Column, last: Column) -> Column:
    """The name from three clean cells."""
    return join_parts(*[clean_name_part(c) for c in (first, middle, last)])


def mailing_address(*cells: Column) -> Column:
    """The address from clean cells; case and inner blanks stay as they are."""
    return join_parts(*cells)


@lru_cache(maxsize=1)
def _digit_class() -> str:
    """Java character class of every digit, including superscripts and circled digits.

    Built from Python's digit property, as the JVM's tables may be of an older Unicode version.
    """
    points = [p for p in range(0x110000) if chr(p).isdigit()]
    starts = [p for i, p in enumerate(points) if i == 0 or points[i - 1] != p - 1]
    ends = [p for i, p in enumerate(points) if i == len(points) - 1 or points[i + 1] != p + 1]
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in zip(starts, ends))


def tel_link(c: Column) -> Column:
    """``tel:+<digits>`` for a phone number, '' when it holds no digit.

    Ten digits are a national number and get the country code 1.
    """
    phone = F.coalesce(c, F.lit(""))
    ascii_only = F.length(phone) == F.octet_length(phone)
    # Other scripts: drop what cannot be a digit first, so that the exact class sees little text.
    # Code points unknown to the JVM may be digits.
    maybe_digits = F.regexp_replace(phone, r"[^\p{N}\p{Cn}]+", "")
    digits = F.when(ascii_only, F.regexp_replace(phone, "[^0-9]+", "")).otherwise(
        F.regexp_replace(maybe_digits, f"[^{_digit_class()}]+", "")
    )
    return (
        F.when(digits == "", F.lit(""))
        .when(F.length(digits) == 10, F.concat(F.lit("tel:+1"), digits))
        .otherwise(F.concat(F.lit("tel:+"), digits))
    )
