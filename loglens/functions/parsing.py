"""Column-expression builders for log parsing.

Everything here returns ``pyspark.sql.Column`` built from JVM-side
built-ins, so parsing stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.functions import patterns as P

# The single-pass extractor joins groups with char(1); a line that already
# contains that byte falls back to per-group extraction, so any input is
# handled exactly.


def extract_groups_naive(value: Column, pattern: str, names: tuple[str, ...]) -> list[Column]:
    """One ``regexp_extract`` per group (one regex match per field)."""
    return [F.regexp_extract(value, pattern, i + 1).alias(n) for i, n in enumerate(names)]


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_groups(df: DataFrame, value: str, pattern: str, names: tuple[str, ...],
                keep: list[str], keep_source: bool = False) -> DataFrame:
    """Project ``keep`` plus every group of ``pattern`` matched on ``value``.

    Single pass: one ``regexp_replace`` rewrites a matching line to its
    groups joined by a separator, ``split`` cuts it back. Results equal
    ``regexp_extract(value, pattern, i)`` for every i: NULL for NULL
    input, '' for every field of a line that does not match. The split
    array is materialised in its own projection so Catalyst evaluates the
    regex once per row rather than once per field.

    The projection is written as SQL (one ``selectExpr`` per step) with raw
    string literals, so the pattern reaches the JVM verbatim whatever the
    session's escaping settings. ``keep_source`` keeps the parsed column.
    """
    if "'" in pattern:
        raise ValueError("pattern must not contain a single quote")
    n = len(names)
    pat = f"r'{pattern}'"
    tail = f"r'{pattern}[\\s\\S]*'"
    template = ", char(1), ".join(f"'${i}'" for i in range(1, n + 1))
    v = _ident(value)
    tmp = "__loglens_parts"
    kept = [_ident(k) for k in keep if k != value]
    # The tail swallows the rest of the line (newlines included), so the
    # anchored pattern can match at most once.
    sep = "__loglens_has_sep"
    staged = df.selectExpr(*kept, v, f"split(regexp_replace({v}, {tail}, concat({template})), "
                                     f"char(1), -1) AS {tmp}",
                           f"contains({v}, char(1)) AS {sep}")
    fields = [
        f"CASE WHEN {v} IS NULL THEN CAST(NULL AS STRING) "
        f"WHEN {sep} THEN regexp_extract({v}, {pat}, {i + 1}) "
        f"WHEN size({tmp}) = {n} THEN {tmp}[{i}] ELSE '' END AS {_ident(name)}"
        for i, name in enumerate(names)]
    return staged.selectExpr(*kept, *([v] if keep_source else []), *fields)


def with_groups_matched(df: DataFrame, value: str, pattern: str, names: tuple[str, ...],
                        keep: list[str]) -> DataFrame:
    """Like ``with_groups`` but only for lines the pattern matches.

    The parse yields a zero- or one-element array that ``inline`` turns
    into rows, so non-matching lines vanish inside the generator. A row
    filter would instead be pushed below the parse projection and run the
    regex a second time; predicates on generator output stay above it.
    """
    if "'" in pattern:
        raise ValueError("pattern must not contain a single quote")
    n = len(names)
    pat = f"r'{pattern}'"
    tail = f"r'{pattern}[\\s\\S]*'"
    template = ", char(1), ".join(f"'${i}'" for i in range(1, n + 1))
    v = _ident(value)
    tmp, sep = "__loglens_parts", "__loglens_has_sep"
    kept = [_ident(k) for k in keep if k != value]
    staged = df.selectExpr(*kept, v, f"split(regexp_replace({v}, {tail}, concat({template})), "
                                     f"char(1), -1) AS {tmp}",
                           f"contains({v}, char(1)) AS {sep}")
    fast = ", ".join(f"'{name}', {tmp}[{i}]" for i, name in enumerate(names))
    slow = ", ".join(f"'{name}', regexp_extract({v}, {pat}, {i + 1})" for i, name in enumerate(names))
    rows = (f"CASE WHEN {sep} THEN CASE WHEN {v} RLIKE {pat} THEN array(named_struct({slow})) END "
            f"WHEN size({tmp}) = {n} THEN array(named_struct({fast})) END")
    return staged.selectExpr(*kept, f"inline(coalesce({rows}, array()))")


def endpoint_of(request: Column) -> Column:
    """URI path of a request line, query string removed; '' if none."""
    return F.regexp_extract(request, P.ENDPOINT_PATTERN, 1)


def status_class_of(status: Column) -> Column:
    """'2xx', '4xx', ... from the status text; '' for an unparsed row."""
    return F.when(F.length(status) > 0, F.concat(F.substring(status, 1, 1), F.lit("xx"))) \
        .otherwise(F.lit(""))


def is_error_class(status_class: Column) -> Column:
    """True for status >= 400 ('4xx' .. '9xx')."""
    return status_class >= F.lit("4xx")


def access_time(datetime_text: Column) -> Column:
    """Event time of an access-log time stamp as ``timestamp`` (NULL if bad)."""
    return F.try_to_timestamp(datetime_text, F.lit(P.ACCESS_TIME_FORMAT))


def to_int(text: Column) -> Column:
    """ANSI-safe string -> int (NULL on empty text or overflow)."""
    return text.try_cast("int")


def to_long(text: Column) -> Column:
    """ANSI-safe string -> bigint (NULL on empty text)."""
    return text.try_cast("bigint")


_REGEX_META = set(".^$*+?()[]{}\\")


def matches(text: Column, regex: str) -> Column:
    """``text rlike regex``; an alternation of plain literals (``a|b``) becomes
    substring tests, which give the same answer without the regex engine."""
    alts = regex.split("|")
    if any(ch in _REGEX_META for ch in regex) or not all(alts):
        return text.rlike(regex)
    cond = text.contains(alts[0])
    for alt in alts[1:]:
        cond = cond | text.contains(alt)
    return cond


def _first_match(text: Column, rules, default: str) -> Column:
    out = None
    for regex, label in rules:
        cond = matches(text, regex)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def browser_of(user_agent: Column) -> Column:
    return _first_match(F.coalesce(user_agent, F.lit("")), P.BROWSER_RULES, P.BROWSER_OTHER)


def device_of(user_agent: Column) -> Column:
    ua = F.coalesce(user_agent, F.lit(""))
    out = F.when(ua == "", F.lit(P.DEVICE_EMPTY))
    for regex, label in P.DEVICE_RULES:
        out = out.when(matches(ua, regex), F.lit(label))
    return out.otherwise(F.lit(P.DEVICE_OTHER))


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """The rows of ``df`` for which ``condition`` holds, through a generator.

    Same rows as ``df.where(condition)``, but all columns come out of the
    generator: the optimizer copies neither this nor a later condition below
    the projection that computes them, so a costly parse there runs once per
    row. For stored columns use ``where``, which reaches the scan.
    """
    row = F.struct(*[F.col(_ident(c)).alias(c) for c in df.columns])
    return df.select(F.inline(F.when(condition, F.array(row))))
