"""Text cells of batch tables, path tokens, time names and free-text messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Accepted spellings, in the order in which they are tried.
CASE_ALIASES = ("Case",)
WS_ALIASES = ("WS", "ws", "wind_speed", "U_ref", "u_ref", "met__WS_mps")
WD_ALIASES = ("WD", "wd", "wind_direction", "ref_wind_dir", "relative_wind_direction", "met__WD_deg")

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TIME_NAME = r"^(\d+(\.\d+)?|\.\d+)$"
BLANKS = " \t\n\x0b\f\r"
TIME_LIST = r"^\d+(,\d+)*$"
END_TIME = r"^[+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_cell(c: Column | str, strip_quotes: bool = False) -> Column:
    """Drop carriage returns, then blanks at both ends; NULL becomes ''.

    With ``strip_quotes`` one leading and one trailing double quote go first.
    """
    text = F.translate(F.coalesce(_col(c), F.lit("")), "\r", "")
    if strip_quotes:
        text = F.regexp_replace(F.regexp_replace(text, '^"', ""), '"$', "")
    return F.btrim(text, F.lit(BLANKS))


def _tokenize(text: Column, blank: str) -> Column:
    text = F.regexp_replace(text, blank, "_")
    text = F.regexp_replace(text, r"[^0-9A-Za-z._-]", "_")
    text = F.regexp_replace(text, r"_+", "_")
    return F.btrim(text, F.lit("_"))


def sanitize_token(c: Column | str, strip_quotes: bool = False) -> Column:
    """A file-system-safe token; an empty one becomes ``NA``."""
    return F.regexp_replace(_tokenize(trim_cell(c, strip_quotes), r"\s+"), "^$", "NA")


def case_id(c: Column | str, strip_quotes: bool = False) -> Column:
    """Stage rule for a case id: ``NA`` and ``case_*`` stay, others get the prefix."""
    return F.regexp_replace(sanitize_token(c, strip_quotes), "^(?!case_|NA$)", "case_")


def pair_case_id(c: Column | str) -> Column:
    """Dataset rule for a case id: an empty token is an error (NULL), ``NA`` is a name."""
    text = F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?U)^\s+|\s+$", "")
    token = _tokenize(text, r"(?U)\s+")
    return F.nullif(F.regexp_replace(token, "^(?!case_|$)", "case_"), F.lit(""))


def path_token(c: Column | str) -> Column:
    """A path turned into one token."""
    return sanitize_token(F.translate(_col(c), "/", "_"))


def wall_check_token(c: Column | str) -> Column:
    """The wall-distance check's variant: nothing is collapsed or stripped."""
    return F.regexp_replace(_col(c), r"[^0-9A-Za-z._-]", "_")


def is_number(c: Column | str) -> Column:
    """True when the text is a plain decimal number (no ``nan``, no ``1f``)."""
    return F.coalesce(_col(c).rlike(NUMBER), F.lit(False))


def to_number(c: Column | str) -> Column:
    """The number in a text cell, NULL when it is none."""
    return F.when(is_number(c), _col(c).try_cast("double"))


def is_time_name(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(TIME_NAME), F.lit(False))


def time_value(c: Column | str) -> Column:
    """Time names are kept as text and compared as numbers."""
    return F.when(is_time_name(c), _col(c).try_cast("double"))


def batch_number(c: Column | str) -> Column:
    """Batch number of a file name: after ``batch``, else the digits at the stem's end."""
    name = F.regexp_extract(_col(c), r"([^/]*)$", 1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.coalesce(
        F.nullif(F.regexp_extract(name, r"(?i)batch[_-]?(\d+)", 1), F.lit("")),
        F.nullif(F.regexp_extract(stem, r"(\d+)$", 1), F.lit("")),
    )


def save_times(c: Column | str) -> Column:
    """Requested times: textual distinct in given order, NULL when empty or invalid."""
    parts = F.filter(F.split(_col(c), r"[,;\s]+"), lambda x: x != "")
    names = F.array_distinct(parts)
    return F.when((F.size(names) > 0) & F.forall(names, lambda x: x.rlike(TIME_NAME)), names)


def is_time_list(c: Column | str) -> Column:
    """The strict form of the run option: whole numbers separated by commas."""
    return F.coalesce(_col(c).rlike(TIME_LIST), F.lit(False))


def covers_end_time(end: Column | str, times: Column | str) -> Column:
    """Does the end time reach the greatest requested time? NULL when it is no number."""
    end = _col(end)
    latest = F.array_max(F.transform(_col(times), lambda x: x.try_cast("double")))
    return F.when(end.rlike(END_TIME), end.try_cast("double") >= latest)


def first_absolute_path(c: Column | str) -> Column:
    """First blank-separated token that starts with '/', else ``unavailable``."""
    path = F.regexp_extract(F.coalesce(_col(c), F.lit("")), r"(?:^|\s)(/\S*)", 1)
    return F.coalesce(F.nullif(path, F.lit("")), F.lit("unavailable"))


def general_number(c: Column | str, digits: int = 9) -> Column:
    """A double as C's ``%.<digits>g`` prints it.

    Most cells are short decimals, whose shortest form is the answer already.
    Others are rounded in scientific form, and printed in fixed form when the
    exponent is in [-4, digits).
    """
    value = _col(c)
    shortest = value.cast("string")
    short = (F.abs(value) >= 1e-3) & (F.abs(value) < 1e7) & (F.length(shortest) <= digits)
    sci = F.format_string(f"%.{digits - 1}e", value)
    exponent = F.substring_index(sci, "e", -1).try_cast("int")
    fixed = F.regexp_replace(sci.try_cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    return (
        F.when(value == 0, F.lit("0"))
        .when(short, F.regexp_replace(shortest, r"\.0$", ""))
        .when(exponent.between(-4, digits - 1), fixed)
        .when(value.isNotNull(), F.regexp_replace(sci, r"\.?0*e", "e"))
    )


def uniform_scalar(c: Column | str) -> Column:
    """Boundary text of a scalar cell; NULL marks a missing or invalid cell."""
    text = trim_cell(c)
    return F.when(text == "", F.lit(None)).when(text.startswith("uniform"), text).when(
        is_number(text), F.concat(F.lit("uniform "), text)
    )


def uniform_vector(c: Column | str, number: Column | None = None) -> Column:
    """Boundary text of a velocity cell: a magnitude points to +z, a vector passes.

    ``number`` is the cell's number if the caller has it in a column already.
    """
    text = trim_cell(c)
    number = to_number(text) if number is None else number
    vector = F.contains(text, F.lit("(")) & text.rlike(r"(?s)\(.*\)")
    magnitude = F.concat(F.lit("uniform (0 0 "), general_number(number, 9), F.lit(")"))
    return (
        F.when(number.isNotNull(), magnitude)
        .when(vector & text.startswith("uniform"), text)
        .when(vector, F.concat(F.lit("uniform "), text))
    )


def header_index(header: Column | str, aliases: Sequence[str]) -> Column:
    """Zero-based position of the first alias that a header row has, NULL if none.

    Header cells are trimmed and lower-cased; of two equal ones the later wins.
    """
    keys = F.transform(_col(header), lambda h: F.lower(trim_cell(h)))
    backwards = F.reverse(keys)
    positions = [
        F.nullif(F.array_position(backwards, alias.lower()), F.lit(0)) for alias in aliases
    ]
    return F.size(keys) - F.coalesce(*positions) if len(positions) > 1 else F.size(keys) - positions[0]


def cell(header: Column | str, cells: Column | str, *aliases: str) -> Column:
    """The trimmed cell below the first matching header; '' when it is absent."""
    return trim_cell(F.get(_col(cells), header_index(header, aliases).cast("int")))
