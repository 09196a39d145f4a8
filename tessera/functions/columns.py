"""Column-level building blocks.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen; no Python UDF is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

# The grammar of a decimal float literal accepted by the
# numeric-validity test (sign, digits with optional fraction, or a leading
# dot, optional exponent) and the special spellings nan / inf / infinity.
FLOAT_PATTERN = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
SPECIAL_FLOAT_PATTERN = r"^[+-]?(nan|inf|infinity)$"
# The markers of a corpus line  <doc id="ID" url="URL" ...>TEXT</doc>
ID_OPEN, ID_CLOSE, TEXT_OPEN, TEXT_TAIL_LEN = 'id="', '" url=', '">', 6


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip(c: Column) -> Column:
    # float() ignores surrounding white space, including tabs and newlines
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def is_float_text(c) -> Column:
    """True when a string cell parses as a float (never null)."""
    t = _strip(_col(c))
    ok = t.rlike(FLOAT_PATTERN) | F.lower(t).rlike(SPECIAL_FLOAT_PATTERN)
    return F.coalesce(ok, F.lit(False))


def is_numeric(df: DataFrame, name: str) -> Column:
    """Numeric-validity test that follows the column's type: strings are
    parsed, numeric columns only need to be non-null."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, StringType):
        return is_float_text(name)
    if isinstance(dtype, NumericType):
        return F.col(name).isNotNull()
    return F.col(name).cast("string").isNotNull() & is_float_text(F.col(name).cast("string"))


def to_double(df: DataFrame, name: str) -> Column:
    """The column as double; unparsable strings become null (ANSI-safe)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, NumericType):
        return F.col(name).cast("double")
    s = _strip(F.col(name).cast("string"))
    return F.when(is_float_text(s), s.try_cast("double"))


def safe_div(num, den) -> Column:
    """num / den, null when den is 0 (ANSI mode raises otherwise)."""
    return F.try_divide(_col(num), _col(den))


def tokenize_letters(c) -> Column:
    """Letters-only tokenizer: every non [a-zA-Z] character becomes a blank,
    lower-case, split on runs of blanks, no empty tokens."""
    # one regex pass collapses every run of non-letters into one blank; only
    # ASCII letters and blanks remain, so lower() cannot create new letters
    cleaned = F.lower(F.regexp_replace(_col(c), "[^a-zA-Z]+", " "))
    return F.filter(F.split(cleaned, " "), lambda w: w != "")


def markup_is_valid(line) -> Column:
    """Line carries an id and a url and all three markers the parser needs."""
    line = _col(line)
    return (line.contains("id") & line.contains("url=")
            & (F.instr(line, ID_OPEN) > 0) & (F.instr(line, ID_CLOSE) > 0)
            & (F.instr(line, TEXT_OPEN) > 0))


def markup_id(line) -> Column:
    """Text between the first ``id="`` and the first ``" url=``."""
    line = _col(line)
    start = F.instr(line, ID_OPEN) + F.lit(len(ID_OPEN))
    length = F.greatest(F.instr(line, ID_CLOSE) - start, F.lit(0))
    return F.substring(line, start, length)


def markup_text(line) -> Column:
    """Everything after the first ``">``, minus the closing tag (last 6 characters)."""
    line = _col(line)
    body = F.substring(line, F.instr(line, TEXT_OPEN) + F.lit(len(TEXT_OPEN)), F.lit(2 ** 31 - 1))
    return F.substring(body, F.lit(1), F.greatest(F.char_length(body) - F.lit(TEXT_TAIL_LEN), F.lit(0)))


def prefix_label(c, prefix: str) -> Column:
    """1 when the value starts with ``prefix``, else 0."""
    return F.coalesce(_col(c).startswith(prefix), F.lit(False)).cast("int")


def label_map(c, mapping: dict) -> Column:
    """CASE chain value -> label; unmatched values give null."""
    c = _col(c)
    expr = None
    for value, label in mapping.items():
        expr = F.when(c == value, F.lit(label)) if expr is None else expr.when(c == value, F.lit(label))
    return expr
