"""Tolerant text parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: the first numeric token, digits with '.'/',' separators and an optional exponent.
NUMBER_TOKEN = r"[-+]?([0-9][0-9.,]*[0-9]|[0-9]|[.][0-9]+)([eE][-+]?[0-9]+)?"


def parse_number(s: Column) -> Column:
    """Number from messy text, null when there is none.

    Separator rule: with both '.' and ',' the later one is the decimal mark; a single
    ',' alone is a decimal mark; repeated ',' or repeated '.' are thousands marks."""
    tok = F.regexp_extract(F.trim(s), NUMBER_TOKEN, 0)
    n_dot = F.length(tok) - F.length(F.regexp_replace(tok, "[.]", ""))
    n_com = F.length(tok) - F.length(F.regexp_replace(tok, ",", ""))
    last_dot = F.length(tok) - F.instr(F.reverse(tok), ".")
    last_com = F.length(tok) - F.instr(F.reverse(tok), ",")
    norm = (F.when((n_dot > 0) & (n_com > 0) & (last_com > last_dot),
                   F.regexp_replace(F.regexp_replace(tok, "[.]", ""), ",", "."))
            .when((n_dot > 0) & (n_com > 0), F.regexp_replace(tok, ",", ""))
            .when(n_com == 1, F.regexp_replace(tok, ",", "."))
            .when(n_com > 1, F.regexp_replace(tok, ",", ""))
            .when(n_dot > 1, F.regexp_replace(tok, "[.]", ""))
            .otherwise(tok))
    return F.when(tok == "", F.lit(None).cast("double")).otherwise(norm.try_cast("double"))


def parse_number_sql(x: str) -> str:
    """The same rule in DuckDB SQL (used by the oracle)."""
    tok = f"regexp_extract(trim({x}), '{NUMBER_TOKEN}', 0)"
    nd = f"(length({tok}) - length(replace({tok}, '.', '')))"
    nc = f"(length({tok}) - length(replace({tok}, ',', '')))"
    ld = f"(length({tok}) - strpos(reverse({tok}), '.'))"
    lc = f"(length({tok}) - strpos(reverse({tok}), ','))"
    norm = (f"CASE WHEN {nd} > 0 AND {nc} > 0 AND {lc} > {ld} THEN replace(replace({tok}, '.', ''), ',', '.') "
            f"WHEN {nd} > 0 AND {nc} > 0 THEN replace({tok}, ',', '') "
            f"WHEN {nc} = 1 THEN replace({tok}, ',', '.') WHEN {nc} > 1 THEN replace({tok}, ',', '') "
            f"WHEN {nd} > 1 THEN replace({tok}, '.', '') ELSE {tok} END")
    return f"(CASE WHEN {tok} = '' THEN NULL ELSE TRY_CAST({norm} AS DOUBLE) END)"


# Fixed value: what an unparsable timestamp becomes (sorts before every real one).
MIN_TIMESTAMP = "0001-01-01 00:00:00"


def parse_timestamp(s: Column) -> Column:
    """ISO-like timestamp text ('T' or space separator, optional fraction, optional 'Z' or
    UTC offset) as timestamp_ntz in UTC; unparsable or empty -> the minimum timestamp."""
    offset = F.regexp_extract(F.trim(s), r":\d\d(?:[.]\d+)?\s*([+-]\d\d):?(\d\d)?$", 1)
    rest = F.regexp_extract(F.trim(s), r":\d\d(?:[.]\d+)?\s*([+-]\d\d):?(\d\d)?$", 2)
    minutes = F.coalesce(offset.try_cast("int"), F.lit(0)) * 60 + F.when(offset.startswith("-"), -1).otherwise(1) * F.coalesce(
        rest.try_cast("int"), F.lit(0))
    clean = F.regexp_replace(F.trim(s), r"Z$|(?<=:\d\d|[.]\d{1,9})\s*[+-]\d\d:?(?:\d\d)?$", "")
    ts = clean.try_cast("timestamp_ntz") - F.make_dt_interval(mins=minutes)
    return F.coalesce(ts, F.lit(MIN_TIMESTAMP).cast("timestamp_ntz"))


def parse_timestamp_sql(x: str) -> str:
    return (f"coalesce(TRY_CAST(regexp_replace(trim({x}), 'Z$', '') AS TIMESTAMP), "
            f"TIMESTAMP '{MIN_TIMESTAMP}')")
