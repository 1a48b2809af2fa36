"""Column functions: ids, urls, dates, durations, safe arithmetic, money."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONED = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"

#: Fixed day bands (inclusive) of reported durations.
BANDS = (("quarter", 70, 110), ("half_year", 150, 220), ("nine_months", 240, 300), ("annual", 300, 380))

#: Fixed factors of money units.
MONEY_UNITS = (
    ("USD", "USD", 1), ("USD_million", "USD", 10**6), ("USD_billion", "USD", 10**9),
    ("JPY", "JPY", 1), ("JPY_million", "JPY", 10**6), ("JPY_billion", "JPY", 10**9),
)


def stable_id(*parts: Column, prefix: str | None = None, digits: int = 24) -> Column:
    """The first hex digits of the SHA-256 of the parts joined by |; a null part counts as empty."""
    text = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    short = F.substring(F.sha2(text, 256), 1, digits)
    return F.concat(F.lit(prefix + ":"), short) if prefix else short


def path_id(*parts: Column) -> Column:
    """Readable ids such as fact:company:period:concept."""
    return F.concat_ws(":", *parts)


def filing_url(base: str, cik: Column, accession: Column) -> Column:
    """The folder of a filing: cik without leading zeros, accession without dashes."""
    return F.concat(F.lit(base.rstrip("/") + "/"), cik.cast("long").cast("string"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")))


def padded_cik(cik: Column) -> Column:
    return F.lpad(cik.cast("string"), 10, "0")


def normal_url(url: Column) -> Column:
    """Scheme and host in lower case, no fragment; null if it can't be parsed."""
    plain = F.regexp_replace(url, "#.*$", "")
    head = F.regexp_extract(plain, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1)
    return F.when(F.length(head) > 0, F.concat(F.lower(head), F.substr(plain, F.length(head) + 1)))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1))


def allowed_url(url: Column, hosts: list[str], prefix: str = "/") -> Column:
    """https, an allowed host, and a path under the prefix."""
    path = F.regexp_extract(url, r"^https://[^/?#]*([^?#]*)", 1)
    return url.startswith("https://") & host(url).isin(hosts) & path.startswith(prefix)


def single_query_value(url: Column, key: str) -> Column:
    """The value of a query key that occurs just once, else null."""
    found = F.regexp_extract_all(url, F.lit(rf"[?&]{key}=([^&#]*)"), F.lit(1))
    return F.when(F.size(found) == 1, F.get(found, 0))


def url_cik(url: Column) -> Column:
    """The number of a url's only CIK key, if it has 1 to 10 digits and is over zero."""
    text = single_query_value(url, "CIK")
    return F.when(text.rlike(r"^[0-9]{1,10}$") & (text.try_cast("long") > 0), text.try_cast("long"))


def bound(value: Column, made) -> Column:
    """made(value), an expression that may name the value often, with the value itself evaluated once."""
    return F.get(F.transform(F.array(value), made), 0)


def instant(text: Column) -> Column:
    """A timestamp from text that names its zone; null without one."""
    return F.when(text.rlike(ZONED), F.try_to_timestamp(text))


def utc_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def any_date(text: Column) -> Column:
    """A date from yyyy-MM-dd (first ten characters), yyyyMMdd, yyyy/MM/dd or an English month name."""
    head = F.substring(text, 1, 10)
    formats = ((head, "yyyy-MM-dd"), (text, "yyyyMMdd"), (head, "yyyy/MM/dd"), (text, "MMMM d, yyyy"))
    return F.coalesce(*(F.try_to_timestamp(t, F.lit(f)).cast("date") for t, f in formats))


def url_date(url: Column) -> Column:
    """A calendar date inside a url, as 2024-05-31, 2024/05/31 or 20240531; impossible dates count as none."""
    dashed = F.regexp_extract(url, r"(20\d{2})[-/_](\d{1,2})[-/_](\d{1,2})", 0)
    solid = F.regexp_extract(url, r"(?<!\d)(20\d{6})(?!\d)", 1)
    return F.coalesce(
        F.try_to_timestamp(F.regexp_replace(dashed, "[/_]", "-"), F.lit("yyyy-M-d")).cast("date"),
        F.try_to_timestamp(solid, F.lit("yyyyMMdd")).cast("date"))


def days(start: Column, end: Column, inclusive: bool = False) -> Column:
    return F.datediff(end, start) + (1 if inclusive else 0)


def duration_band(length: Column, bands=BANDS) -> Column:
    """The first band that holds the number of days, or null."""
    out = None
    for name, low, high in bands:
        hit = length.between(low, high)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def period_type(start: Column, end: Column, fiscal_period: Column) -> Column:
    """annual or quarter by the fiscal period, else duration; instant without a start, unknown without both."""
    open_ended = F.when(end.isNotNull(), "instant").otherwise("unknown")
    named = F.when(fiscal_period == "FY", "annual").when(fiscal_period.startswith("Q"), "quarter").otherwise("duration")
    return F.when(start.isNull(), open_ended).otherwise(named)


def safe_divide(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def ratio_change(now: Column, before: Column) -> Column:
    return safe_divide(now, before) - 1


def percent_change(now: Column, before: Column, places: int = 4) -> Column:
    """(now - before) / |before| * 100 in exact decimals, half up; null on a null or zero base, and beyond 14 digits.

    Rounded once, by whole-number division: a quotient with fewer digits first would round twice.
    """
    a, b = now.cast("decimal(28,6)"), before.cast("decimal(28,6)")
    size, base = F.abs(a - b).cast("decimal(28,6)"), F.abs(b)
    fits = (base > 0) & (size.cast("double") / base.cast("double") < 1e12)
    units = F.call_function("div", (size * F.lit(2 * 10 ** (places + 2)).cast("decimal(10,0)") + base).cast("decimal(38,6)"), (base * 2).cast("decimal(30,6)"))
    signed = F.when(a < b, -units).otherwise(units)
    return F.when(fits, (signed.cast("decimal(18,0)") / F.lit(10**places).cast("decimal(10,0)")).cast(f"decimal(18,{places})"))


def growth_rate(first: Column, last: Column, years: Column) -> Column:
    """Compound annual growth; null unless both ends and the span are positive."""
    return F.when((first > 0) & (last > 0) & (years > 0), F.pow(last / first, 1.0 / years) - 1)


def number(text: Column) -> Column:
    """A finite number from text that may hold thousands' commas, else null."""
    parsed = F.replace(text, F.lit(","), F.lit("")).try_cast("double")
    return F.when(~F.isnan(parsed) & (F.abs(parsed) < float("inf")), parsed)


def security_code(code: Column) -> Column:
    """Five-character codes that end in 0 lose it."""
    return F.when((F.length(code) == 5) & code.endswith("0"), F.substring(code, 1, 4)).otherwise(code)


def base_money(rows: DataFrame, value: str, unit: str) -> DataFrame:
    """rows with `currency`, `base_value` and `money_error` (unknown or missing unit); six factors, so a broadcast."""
    spark = rows.sparkSession
    factors = spark.createDataFrame(list(MONEY_UNITS), "unit string, currency string, factor long")
    joined = rows.join(F.broadcast(factors.withColumnRenamed("unit", "_unit")), F.col(unit) == F.col("_unit"), "left")
    error = F.when(F.col(unit).isNull(), "missing_unit").when(F.col("factor").isNull(), "unsupported_unit")
    return joined.select(
        *rows.columns, "currency", (F.col(value).cast("decimal(28,6)") * F.col("factor")).cast("decimal(38,6)").alias("base_value"),
        error.alias("money_error"))


def convert(rows: DataFrame, rates: DataFrame, to: str) -> DataFrame:
    """rows (currency, base_value) with `converted` at an explicit rate (currency, quote, rate); no rate is an error."""
    quoted = rates.where(F.col("quote") == to).select(F.col("currency").alias("_from"), F.col("rate").cast("decimal(28,10)").alias("_rate"))
    joined = rows.join(quoted, F.col("currency") == F.col("_from"), "left")
    same = F.col("currency") == to
    value = F.when(same, F.col("base_value")).otherwise((F.col("base_value") / F.col("_rate")).cast("decimal(38,6)"))
    error = F.when(~same & F.col("_rate").isNull(), "missing_rate")
    return joined.select(*rows.columns, value.alias("converted"), error.alias("rate_error"))
