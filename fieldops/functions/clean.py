"""Typing and cleaning helpers (column -> column).  All native expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldops import config

_NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Characters Python's str.strip() removes (Unicode whitespace), derived by rule.
_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once however often it is used; inlined
    copies of a long expression grow the generated code and its time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column | str) -> Column:
    """Trim any whitespace (tabs, line breaks, no-break spaces) at both ends."""
    return F.btrim(_col(c), F.lit(_WHITESPACE))


def null_tokens(c: Column | str, tokens: Iterable[str] = config.NULL_TOKENS) -> Column:
    """Values equal to a null token become NULL (compared before trimming)."""
    c = _col(c)
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)


def pattern_shape(pattern: str) -> str:
    """Regex for the text shape a Spark datetime pattern can parse (digits
    per field, literal separators).  Used as a cheap guard: a failed parse
    costs an exception inside the JVM, a failed regex match does not."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        j = i
        while j < len(pattern) and pattern[j] == ch:
            j += 1
        run = j - i
        if ch == "y":
            out.append(r"\d{4}" if run >= 4 else r"\d{2}")
        elif ch in "dMHhms":
            out.append(r"\d{1,2}")
        elif ch == "a":
            out.append("[AaPp][Mm]")
        else:
            out.append(re.escape(ch) * run)
        i = j
    return "^" + "".join(out) + "$"


def wall_clock(s: Column, pattern: str) -> Column:
    """Text -> TIMESTAMP_NTZ by one pattern, NULL where it doesn't parse.  The
    text is read as UTC and never passes through the session's zone, whose
    clock changes would move it."""
    instant = F.try_to_timestamp(F.concat(s, F.lit(" Z")), F.lit(pattern + " X"))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def parse_ts(c: Column | str, formats: Iterable[tuple[str, str]] = config.DATETIME_FORMATS) -> Column:
    """Trim, then the first format that parses wins; otherwise NULL.

    Two-digit years follow the C library rule (69-99 -> 19xx, 00-68 -> 20xx);
    Spark reads ``yy`` as 20xx, so those branches move 70-99 back a century.
    Each format is tried only when the text has its shape, so a row costs at
    most one real parse attempt.  Result type is TIMESTAMP_NTZ."""
    raw = null_tokens(_col(c).cast("string"))
    s = strip(raw)
    tries = []
    for _py, pattern in formats:
        parsed = wall_clock(s, pattern)
        if "yyyy" not in pattern and "yy" in pattern:
            parsed = F.when(F.year(parsed) >= 2069, F.timestamp_add("YEAR", F.lit(-100), parsed)).otherwise(parsed)
        tries.append(F.when(s.rlike(pattern_shape(pattern)), parsed))
    return F.coalesce(*tries) if len(tries) > 1 else tries[0]


def fmt_ts(c: Column | str) -> Column:
    """Timestamp -> 'yyyy-MM-dd HH:mm:ss' text, NULL stays NULL.  (The text
    form of a TIMESTAMP_NTZ without its fraction; no zone takes part.)"""
    return F.substring_index(_col(c).cast("timestamp_ntz").cast("string"), ".", 1)


def to_double(c: Column | str) -> Column:
    """Numeric text -> DOUBLE; anything that is not a plain decimal number
    (e.g. '5d', 'abc', '') -> NULL."""
    s = _col(c).cast("string")
    return F.when(s.rlike(_NUMERIC_TEXT), strip(s).try_cast("double"))


def to_integer(c: Column | str) -> Column:
    """INTEGER contract: numeric text rounded half-to-even, as BIGINT; beyond
    its range NULL."""
    return F.bround(to_double(c), 0).try_cast("bigint")


def cast_to(c: Column | str, kind: str) -> Column:
    """C4: cast one column by contract type."""
    kind = kind.upper()
    c = _col(c)
    if kind == "INTEGER":
        return to_integer(c)
    if kind == "REAL":
        return to_double(c)
    if kind == "TEXT":
        return c.cast("string")
    if kind == "DATE":
        return parse_date_text(c).cast("date")
    if kind == "DATETIME":
        return parse_ts(c)
    raise ValueError(f"unknown contract type {kind}")


def parse_date_text(c: Column) -> Column:
    """DATE contract: ISO date (optionally with a time part) -> DATE, else NULL."""
    s = strip(c.cast("string"))
    return F.coalesce(*[F.when(s.rlike(pattern_shape(p)), wall_clock(s, p))
                        for p in ("yyyy-M-d H:m:s", "yyyy-M-d")])


def apply_contract(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """C4: one projection casting every contract column; other columns pass."""
    return df.select(*[
        cast_to(name, contract[name]).alias(name) if name in contract else F.col(f"`{name}`")
        for name in df.columns
    ])


def unparsed_report(df: DataFrame, columns: Iterable[str], order: Column | str, limit: int = 20) -> DataFrame:
    """Per column, the first ``limit`` raw values that failed C1.

    Returns (column, raw, rn); the limit is the feature (a short sample)."""
    raws = [F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").cast("string").alias("raw")) for name in columns]
    # one scan: each row carries its (column, raw) pairs, failures stay
    out = (df.select(_col(order).alias("_ord"), F.inline(F.array(*raws)))
           .where(null_tokens("raw").isNotNull() & parse_ts("raw").isNull()))
    w = Window.partitionBy("column").orderBy(F.col("_ord").asc_nulls_last(), F.col("raw"))
    return (out.withColumn("rn", F.row_number().over(w).cast("bigint"))
            .where(F.col("rn") <= limit).drop("_ord"))


def normalize_names(df: DataFrame) -> DataFrame:
    """Spaces in column names become underscores."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def project_as(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep only the mapped columns, renamed, in map order."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])


def drop_if(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns when present."""
    return df.drop(*[c for c in cols if c in df.columns])


def strip_literal(c: Column | str, literal: str) -> Column:
    """Remove a literal substring (not a regex), then trim."""
    return strip(F.replace(_col(c), F.lit(literal), F.lit("")))


#: Spark types that already are a contract type.
CONTRACT_TYPES = {"INTEGER": ("byte", "short", "integer", "long"), "REAL": ("float", "double"), "TEXT": ("string",), "DATE": ("date",),
                  "DATETIME": ("timestamp", "timestamp_ntz")}


def ensure_contract(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """C4 for a table that may be typed already: casts the contract columns that
    are of another type; a report read back from text gets its types again."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    cast = {c: k for c, k in contract.items() if c in kinds and kinds[c] not in CONTRACT_TYPES[k.upper()]}

    def typed(c: str) -> Column:
        return bind(F.col(f"`{c}`"), lambda v: cast_to(v, cast[c])).alias(c)

    return df.select(*[typed(c) if c in cast else F.col(f"`{c}`") for c in df.columns])


def strip_suffix(c: Column | str, pattern: str = config.RX_PETITION_SUFFIX) -> Column:
    """Trim, then drop a trailing '-dd'."""
    return F.regexp_replace(strip(_col(c)), pattern, "")


def canon_id(c: Column | str, width: int = 8) -> Column:
    """C11: numeric ids -> integer text zero-filled to ``width`` (never
    truncated); other text passes unchanged, and so do numbers of more than 38
    digits; NULL/'' -> NULL."""
    s = _col(c).cast("string")

    def digits(t: Column) -> Column:
        """Integer text of numeric text; as a decimal only where a double isn't exact."""
        return bind(t.try_cast("double"), lambda x: F.when(F.abs(x) < float(1 << 53), x.try_cast("bigint").cast("string"))
                    .otherwise(t.try_cast("decimal(38,0)").cast("string")))

    def filled(d: Column) -> Column:
        fill = lambda body, n: F.lpad(body, F.greatest(F.length(body), F.lit(n)), F.lit("0"))
        return F.when(d.startswith("-"), F.concat(F.lit("-"), fill(F.substring(d, 2, 1 << 30), width - 1))).otherwise(fill(d, width))

    number = bind(bind(strip(s), digits), filled)
    plain = F.substring_index(s, ".", 1)  # the usual case, which needs no parsing
    return F.when(s.isNull() | (s == ""), F.lit(None)).when(
        s.rlike(r"^[1-9][0-9]{0,14}(\.0+)?\z"), F.lpad(plain, F.greatest(F.length(plain), F.lit(width)), F.lit("0"))).when(s.rlike(_NUMERIC_TEXT), F.coalesce(number, s)).otherwise(s)


def zero_fill(c: Column | str, width: int) -> Column:
    """Zero-fill text to ``width``; longer text is kept whole (LPAD would cut it)."""
    s = _col(c).cast("string")
    return F.lpad(s, F.greatest(F.length(s), F.lit(width)), F.lit("0"))


def composite_key(*cols: Column | str, sep: str = "_") -> Column:
    """Join parts with ``sep``; a NULL part counts as ''."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


def incident_key(ticket: Column | str, petition: Column | str) -> Column:
    """The ticket id when it looks like INC+7 digits, else the petition."""
    t = _col(ticket)
    return F.when(t.rlike(config.RX_INCIDENT_ID), t).otherwise(_col(petition))


def blank_placeholders(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """C14: for publishing, 0, NULL, 'nan' and 'None' become ''.  Every touched
    column becomes text."""
    cols = set(df.columns if cols is None else cols)
    return df.select(*[blanked(df, c).alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def blanked(df: DataFrame, name: str) -> Column:
    """C14 for one column of ``df``."""
    c = F.col(f"`{name}`")
    tname = df.schema[name].dataType.typeName()
    if tname in ("integer", "long", "short", "byte", "double", "float", "decimal"):
        return F.when(c.isNull() | (c == 0), F.lit("")).otherwise(c.cast("string"))
    if tname == "string":
        return F.when(c.isNull() | c.isin("nan", "None"), F.lit("")).otherwise(c)
    return F.when(c.isNull(), F.lit("")).otherwise(c.cast("string"))


def fixed_length(c: Column | str, n: int = 8, most: int | None = None) -> Column:
    """Predicate, text has exactly ``n`` characters (``n`` to ``most`` where that is given)."""
    return F.length(_col(c)).between(n, n if most is None else most)
