"""Text, number and time expressions shared by every job, as Spark SQL fragments.

Each function takes SQL expressions and returns one, so a job hands Spark a whole projection at
once. All of them stay inside the JVM.
"""

from __future__ import annotations

# The characters that count as blank at either end of a text.
BLANKS = (
    r"\t\n\u000B\u000C\r\u001C\u001D\u001E\u001F\u0020\u0085\u00A0\u1680"
    r"\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200A"
    r"\u2028\u2029\u202F\u205F\u3000"
)

# Accepted spellings of decimals, integers and ISO-8601 instants.
DECIMAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
NON_FINITE_PATTERN = r"(?i)^[+-]?(inf|infinity|s?nan[0-9]*)$"
INTEGER_PATTERN = r"^[+-]?[0-9]+(_[0-9]+)*$"
INSTANT_PATTERN = (
    r"^([0-9]{4})-?([0-9]{2})-?([0-9]{2})"
    r"(?:[T ]([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]+))?)?)?"
    r"([+-][0-9]{2}(?::?[0-9]{2})?)?)?$"
)
# Fixed value: the common spelling, which Spark reads by itself.
PLAIN_INSTANT_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?(Z|[+-][0-9]{2}:[0-9]{2})$"
)
PLAIN_LOCAL_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?)?\z"
DASH = "'—'"


def quoted(text: str) -> str:
    """SQL literal of a Python text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stripped(text: str) -> str:
    """Strip blanks at both ends; a blank text stays an empty text."""
    return f"btrim({text}, '{BLANKS}')"


def trimmed(text: str) -> str:
    """Strip blanks at both ends; a blank text becomes null."""
    bare = f"nullif({stripped(text)}, '')"
    if not text.isidentifier():
        return bare
    # Most values start and end with a visible ASCII character, which costs less to see than a search for blanks.
    visible = f"{text} >= '!' AND {text} < '\\u007F' AND ascii(substr({text}, -1)) BETWEEN 33 AND 126"
    return f"CASE WHEN {visible} THEN {text} ELSE {bare} END"


def parse_decimal(text: str) -> str:
    """Finite decimal or null. Underscores between digits are allowed, as in source systems."""
    plain = f"replace({text}, '_', '')"
    return f"CASE WHEN {plain} RLIKE r'{DECIMAL_PATTERN}' THEN try_cast({plain} AS DECIMAL(38,10)) END"


def is_non_finite(text: str) -> str:
    return f"{text} RLIKE r'{NON_FINITE_PATTERN}'"


def parse_integer(text: str) -> str:
    return f"CASE WHEN {text} RLIKE r'{INTEGER_PATTERN}' THEN try_cast(replace({text}, '_', '') AS INT) END"


def parse_boolean(text: str) -> str:
    return (
        f"CASE WHEN lower({text}) IN ('true', '1', 'yes') THEN true "
        f"WHEN lower({text}) IN ('false', '0', 'no') THEN false END"
    )


def parse_instant(text: str, *, assume_utc: bool = False) -> str:
    """ISO-8601 text to a UTC timestamp; null when malformed, or when no offset is given (unless
    such texts are to be read as UTC).

    Short on purpose: a projection of several instants must stay small enough to be compiled.
    """
    spelled = f"replace({text}, 'Z', '+00:00')"
    # Parts that are not given leave their separators side by side; the fraction ends up with six digits.
    parts = f"regexp_replace({spelled}, r'{INSTANT_PATTERN}(?s:.*)', '$1-$2-$3 $4:$5:$6.$7')"
    clock = f"replace(replace(replace({parts}, ' :', ' 00:'), '::', ':00:'), ':.', ':00.')"
    local = f"rpad(substr({clock}, 1, 26), 26, '0')"
    offset = f"regexp_extract({spelled}, r'{INSTANT_PATTERN}', 8)"
    zone = f"overlay(rpad(replace({offset}, ':', ''), 5, '0') PLACING ':' FROM 4 FOR 0)"
    naive = ""
    if assume_utc:
        # The common spellings without an offset, and then all.
        at = f"CASE WHEN length({text}) = 10 THEN concat({text}, ' 00:00:00') ELSE {text} END"
        naive = (
            f"WHEN {text} RLIKE r'{PLAIN_LOCAL_PATTERN}' THEN try_cast(concat({at}, '+00:00') AS TIMESTAMP) "
        )
    bare = f"try_cast(concat({local}, '+00:00') AS TIMESTAMP)" if assume_utc else "NULL"
    return (
        f"CASE WHEN {text} RLIKE r'{PLAIN_INSTANT_PATTERN}' THEN try_cast({text} AS TIMESTAMP) {naive}"
        f"WHEN NOT {spelled} RLIKE r'{INSTANT_PATTERN}' THEN NULL "
        f"WHEN {offset} = '' THEN {bare} ELSE try_cast(concat({local}, {zone}) AS TIMESTAMP) END"
    )


def lacks_offset(text: str) -> str:
    """True for a well-formed ISO date or time without an offset."""
    offset = f"regexp_extract(replace({text}, 'Z', '+00:00'), r'{INSTANT_PATTERN}', 8)"
    return f"({offset} = '' AND {parse_instant(text, assume_utc=True)} IS NOT NULL)"


def python_literal(text: str) -> str:
    """Quoted form of a text as messages show it."""
    doubled = rf"replace({text}, '\\', '\\\\')"
    return (
        f"CASE WHEN contains({text}, '\\'') AND NOT contains({text}, '\"') THEN concat('\"', {doubled}, '\"') "
        rf"ELSE concat('\'', replace({doubled}, '\'', '\\\''), '\'') END"
    )


def _clock_text(instant: str, zone: str) -> str:
    return (
        f"concat(date_format({instant}, \"yyyy-MM-dd'T'HH:mm:ss\"), "
        f"CASE WHEN unix_micros({instant}) % 1000000 = 0 THEN '' ELSE date_format({instant}, '.SSSSSS') END, '{zone}')"
    )


def iso_offset(instant: str) -> str:
    """`2025-01-15T12:00:00+00:00`, with six fraction digits only when they are not zero."""
    return _clock_text(instant, "+00:00")


def iso_z(instant: str) -> str:
    """Wire form of an instant: as :func:`iso_offset`, ending in `Z`."""
    return _clock_text(instant, "Z")


def iso_micros(instant: str) -> str:
    """Hash form of an instant: always six fraction digits, ending in `Z`."""
    return f"date_format({instant}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"


def fixed_text(number: str, places: int) -> str:
    """Decimal text with a fixed number of places, ties to even; null reads as zero."""
    return f"CAST(CAST(bround(coalesce({number}, 0), {places}) AS DECIMAL(38,{places})) AS STRING)"


def money_text(number: str) -> str:
    return fixed_text(number, 2)


def quantity_text(number: str) -> str:
    return fixed_text(number, 3)


def fact_text(number: str) -> str:
    """Decimal text of a fact: a zero of any scale prints as a bare `0`."""
    return f"CASE WHEN {number} = 0 THEN '0' ELSE CAST({number} AS STRING) END"


def plain_decimal_text(number: str) -> str:
    """Decimal text without insignificant zeros."""
    text = f"CAST({number} AS STRING)"
    return rf"CASE WHEN contains({text}, '.') THEN regexp_replace({text}, r'\.?0+$', '') ELSE {text} END"


def ascii_json(json: str) -> str:
    r"""Escape everything outside printable ASCII as `\uXXXX`, one escape per UTF-16 unit."""
    units = f"regexp_extract_all(hex(encode({json}, 'UTF-16BE')), '(.{{4}})', 1)"
    escaped = (
        f"array_join(transform({units}, unit -> CASE WHEN unit < '007F' "
        rf"THEN char(CAST(conv(unit, 16, 10) AS BIGINT)) ELSE concat('\\u', lower(unit)) END), '')"
    )
    return rf"CASE WHEN {json} RLIKE r'[^\x20-\x7e]' THEN {escaped} ELSE {json} END"


def json_object(fields: dict[str, str], *, keep_nulls: bool = False) -> str:
    """Compact JSON object with its keys in code-point order."""
    body = ", ".join(f"{fields[name]} AS {name}" for name in sorted(fields))
    options = ", map('ignoreNullFields', 'false')" if keep_nulls else ""
    return f"to_json(struct({body}){options})"


def sha256(text: str) -> str:
    return f"sha2({text}, 256)"


def id_key(text: str) -> str:
    """An id in half the bytes if it is a digest in hexadecimal digits, for rows that are moved; no two ids get one key.

    Digests have 32 bytes, and no other id has: those of 32 bytes, and those that begin as these then do, get zeros before them.
    """
    digest, plain = f"unhex({text})", f"CAST({text} AS BINARY)"
    padded = f"octet_length({text}) = 32 OR startswith({plain}, X'00')"
    return (
        f"CASE WHEN length({text}) = 64 AND lower(hex({digest})) = {text} THEN {digest} "
        f"WHEN {padded} THEN concat(X'{'00' * 33}', {plain}) ELSE {plain} END"
    )


def key_id(key: str) -> str:
    """The id that `id_key` made a key of."""
    return (
        f"CASE WHEN octet_length({key}) = 32 THEN lower(hex({key})) "
        f"WHEN startswith({key}, X'00') THEN CAST(substring({key}, 34) AS STRING) ELSE CAST({key} AS STRING) END"
    )


# Display forms -------------------------------------------------------------


def _or_dash(value: str, shown: str) -> str:
    return f"CASE WHEN {value} IS NULL OR CAST({value} AS STRING) = '' THEN {DASH} ELSE {shown} END"


def enum_label(value: str) -> str:
    """`SLA_BREACH_RISK` becomes `SLA breach risk`."""
    words = f"lower(replace({value}, '_', ' '))"
    sentence = f"concat(upper(substr({words}, 1, 1)), substr({words}, 2))"
    return _or_dash(
        value, f"CASE WHEN {words} LIKE 'sla %' THEN concat('SLA ', substr({words}, 5)) ELSE {sentence} END"
    )


def currency_label(text: str) -> str:
    """`1234.5` becomes `$1,234.50`; a text that is no number is shown as it is."""
    amount = parse_decimal(stripped(f"CAST({text} AS STRING)"))
    return _or_dash(text, f"coalesce(concat('$', format_number({amount}, 2)), CAST({text} AS STRING))")


def timestamp_label(text: str) -> str:
    """ISO text with an offset becomes `2025-01-15 12:00 UTC`; other texts are shown as they are."""
    shown = f"date_format({parse_instant(text)}, \"yyyy-MM-dd HH:mm 'UTC'\")"
    return _or_dash(text, f"coalesce({shown}, {text})")


def confidence_label(text: str) -> str:
    """`0.9000` becomes `90%`, with one decimal only when needed."""
    ratio = parse_decimal(stripped(f"CAST({text} AS STRING)"))
    percent = f"CAST(CAST(bround(({ratio}) * 100, 1) AS DECIMAL(38,1)) AS STRING)"
    return _or_dash(text, rf"coalesce(concat(regexp_replace({percent}, r'\.0$', ''), '%'), CAST({text} AS STRING))")


def kpi_label(value: str, kind: str) -> str:
    """Summary value as shown: count, money or percent."""
    if kind == "money":
        return currency_label(value)
    suffix = "%" if kind == "percent" else ""
    return f"coalesce(concat(CAST({value} AS STRING), '{suffix}'), {DASH})"
