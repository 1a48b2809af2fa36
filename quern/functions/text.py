"""Text out of documents: HTML, legacy encodings, phrases around a product, nested JSON. Arrow-batched where Spark has no function."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def decoded(content: Column, encodings: Sequence[str] = ("utf-8", "cp932", "shift_jis")) -> Column:
    """Text of bytes in the first encoding that fits, else with replacement marks."""

    @F.pandas_udf("string")
    def read(raw: pd.Series) -> pd.Series:
        def one(x):
            if x is None:
                return None
            for e in encodings:
                try:
                    return bytes(x).decode(e)
                except UnicodeDecodeError:
                    continue
            return bytes(x).decode("utf-8", "replace")

        return raw.map(one)

    return read(content)


def visible_text(html: Column) -> Column:
    """Text between tags without scripts and styles, white space collapsed, the commonest entities read."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    bare = F.regexp_replace(F.regexp_replace(bare, r"(?s)<!--.*?-->", " "), r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(_entities(bare), r"\s+", " "))


def distinct_links(html: Column, most: int = 24) -> Column:
    """The first different targets of a page's anchors, in order; what a crawl follows."""
    return F.slice(F.array_distinct(links(html)), 1, most)


def _entities(text: Column) -> Column:
    """The commonest entities read."""
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def links(html: Column) -> Column:
    """Targets of the anchors of a page, in order."""
    quoted = F.regexp_extract_all(html, F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))
    return F.filter(quoted, lambda x: F.trim(x) != "")


#: Fixed phrases of results, and names of figures.
RESULTS = ("financial results", "quarterly results", "earnings release", "results for the", "results of operations")
FIGURES = ("revenue", "net income", "operating income")
MOST_CHARACTERS = 500_000


def earnings_text(text: Column) -> Column:
    """Whether a text, without its tags, has a phrase of results and the name of a figure."""
    plain = F.lower(_entities(F.regexp_replace(F.substring(text, 1, MOST_CHARACTERS), r"<[^>]+>", " ")))
    some = lambda words: F.greatest(*(F.contains(plain, F.lit(w)) for w in words))
    return some(RESULTS) & some(FIGURES)


def sentences(text: Column) -> Column:
    return F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: F.length(F.trim(s)) > 0)


#: Fixed wording of a month's worldwide sales.
MONTHS = "January February March April May June July August September October November December".split()
SALES = (r"(?i)(?:global|worldwide)\s+(?:semiconductor(?:\s+industry)?\s+)?sales[^.]{0,100}?(?:were|was|totaled|reached)\s+\$?([\d,.]+)\s+billion[^.]{0,100}?"
         r"(?:during|in|for)\s+(?:the\s+month\s+of\s+)?(" + "|".join(MONTHS) + r")\s+(20\d{2})")


def monthly_sales(text: Column, least: float = 1.0, most: float = 1000.0) -> Column:
    """Struct (month as its first day, value in billions, sentence, error): the first sentence that states a month's worldwide sales within bounds."""
    from quern.functions.scalars import bound, number

    whole = F.trim(F.regexp_replace(text, r"[\s\u00A0]+", " "))

    def fact(s: Column) -> Column:
        part = lambda m, i: F.regexp_extract(m, SALES, i)  # noqa: E731  of the match alone, which is short
        made = lambda m: F.when(m != "", F.struct(s.alias("sentence"), number(part(m, 1)).alias("value"), F.lower(part(m, 2)).alias("month"), part(m, 3).try_cast("int").alias("year")))
        return bound(F.regexp_extract(s, SALES, 0), made)

    good = F.filter(F.transform(sentences(whole), fact), lambda f: F.coalesce(f["value"].between(least, most), F.lit(False)))
    place = lambda f: F.coalesce(*(F.when(f["month"] == m.lower(), i) for i, m in enumerate(MONTHS, 1)))
    error = lambda f: F.when(f.isNull(), "no unambiguous monthly sales fact")
    return bound(F.get(good, 0), lambda f: F.struct(
        F.make_date(f["year"], place(f), F.lit(1)).alias("month"), f["value"].alias("value"), f["sentence"].alias("sentence"), error(f).alias("error")))


#: Fixed wording of a paragraph that states two changes of a product: its volume, then its price.
FALLS = ("declined", "decreased", "down")
_CHANGE = r"((?:increased|were up|declined|decreased).*?percentage range)"
_PARAGRAPH = r"(?i)\b{product}\b\s+Fiscal\s+Q[1-4]\s+{product}\s+revenue.{{0,700}}?(?:{product}\s+)?Bit shipments\s+{change}(?:\.\s+|,\s+and\s+)Prices\s+{change}"
_BAND = r"((?:low|mid|high)(?:-to-(?:low|mid|high))?[- ]?(?:single[- ]digit|double[- ]digit|teens|\d{2}s))"


def product_changes(text: Column, product: str) -> Column:
    """Struct (volume, price, error) of a product's own paragraph; each has its text, phrase, low and high. Another product's paragraph is not taken."""
    from quern.functions.scalars import bound
    from quern.operators.intervals import phrase_band

    plain = F.regexp_replace(F.regexp_replace(text, "[–—]", "-"), r"\s+", " ")
    plain = F.regexp_replace(plain, r"(?i)\b(low|mid|high)-\s*to-", "$1-to-")
    pattern = _PARAGRAPH.format(product=product, change=_CHANGE)

    def change(paragraph: Column, group: int) -> Column:
        def read(said: Column) -> Column:
            phrase = F.regexp_extract(F.lower(said), _BAND, 1)
            falls = F.greatest(*(F.contains(F.lower(said), F.lit(w)) for w in FALLS))
            made = lambda b: F.when(b["low"].isNotNull(), F.struct(said.alias("text"), phrase.alias("phrase"), b["low"].alias("low"), b["high"].alias("high")))
            return bound(phrase_band(phrase, F.when(falls, "decline").otherwise("increase")), made)

        return bound(F.trim(F.regexp_extract(paragraph, pattern, group)), read)

    def both(paragraph: Column) -> Column:
        return F.struct(change(paragraph, 1).alias("volume"), change(paragraph, 2).alias("price"), (F.coalesce(paragraph, F.lit("")) == "").alias("none"))

    def judged(f: Column) -> Column:
        error = F.when(f["none"], "paragraph not found").when(f["volume"].isNull() | f["price"].isNull(), "no supported percentage phrase")
        return F.struct(f["volume"].alias("volume"), f["price"].alias("price"), error.alias("error"))

    return bound(bound(F.regexp_extract(plain, pattern, 0), both), judged)


def ids_of_page(html: Column, attribute: str = "data-event-id") -> Column:
    """The values of an attribute on a rendered page, in order."""
    return F.regexp_extract_all(html, F.lit(attribute + r"""=["']([^"']+)["']"""), F.lit(1))


def product_window(text: Column, product: str, rivals: Sequence[str], pattern: str, width: int = 700) -> Column:
    """The first match of a pattern in the `width` characters after the product's name, unless a rival is named before it."""
    import re

    find = re.compile(pattern)

    @F.pandas_udf("string")
    def scan(texts: pd.Series) -> pd.Series:
        def one(t):
            for at in re.finditer(re.escape(product), t or "", re.I):
                window = t[at.end() : at.end() + width]
                if hit := find.search(window):
                    before = window[: hit.start()].lower()
                    if not any(r.lower() in before for r in rivals):
                        return hit[0]
            return None

        return texts.map(one)

    return scan(text)


def key_paths(text: Column) -> Column:
    """All key paths of a JSON text, nested and in lists, sorted; null if it can't be parsed."""

    @F.pandas_udf("array<string>")
    def walk(texts: pd.Series) -> pd.Series:
        def paths(x, at):
            if isinstance(x, dict):
                for k, v in x.items():
                    yield (p := f"{at}.{k}" if at else k)
                    yield from paths(v, p)
            elif isinstance(x, list):
                for v in x:
                    yield from paths(v, at + "[]")

        def one(t):
            try:
                return sorted(set(paths(json.loads(t), "")))
            except (TypeError, ValueError):
                return None

        return texts.map(one)

    return walk(text)


def string_values(text: Column) -> Column:
    """All text values of a JSON text with their paths ($.a[0].b), in document order; null if it can't be parsed."""

    @F.pandas_udf("array<struct<path:string,value:string>>")
    def walk(texts: pd.Series) -> pd.Series:
        def values(x, at):
            if isinstance(x, dict):
                for k, v in x.items():
                    yield from values(v, f"{at}.{k}")
            elif isinstance(x, list):
                for i, v in enumerate(x):
                    yield from values(v, f"{at}[{i}]")
            elif isinstance(x, str):
                yield {"path": at, "value": x}

        def one(t):
            try:
                return list(values(json.loads(t), "$"))
            except (TypeError, ValueError):
                return None

        return texts.map(one)

    return walk(text)


def canonical_hash(text: Column) -> Column:
    """SHA-256 of a JSON text with sorted keys, no spaces and non-ASCII kept; null if it can't be parsed."""

    @F.pandas_udf("string")
    def canon(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            except (TypeError, ValueError):
                return None

        return texts.map(one)

    return F.sha2(canon(text), 256)


def table_rows(html: Column) -> Column:
    """The rows of a page's tables as arrays of cell texts; rows without cells are left out."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))
    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), F.lit(1)), visible_text)
    return F.filter(F.transform(rows, cells), lambda r: F.size(r) > 0)


def snake(text: Column) -> Column:
    """Words of letters and digits in lower case, joined by underscores."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "_"), r"^_+|_+$", ""))


def inferred_period(text: Column) -> tuple[Column, Column, Column]:
    """(period_end, fiscal_quarter, fiscal_year) as a text states them; nothing is guessed from one for another."""
    from quern.functions.scalars import any_date

    end = any_date(F.regexp_extract(text, r"(?i)\b(?:ended|ending|as of)\s+([A-Z][a-z]+ \d{1,2}, \d{4})", 1))
    word = F.lower(F.regexp_extract(text, r"(?i)\b(first|second|third|fourth)[ -](?:fiscal )?quarter", 1))
    named = F.when(word == "first", 1).when(word == "second", 2).when(word == "third", 3).when(word == "fourth", 4)
    quarter = F.coalesce(F.regexp_extract(text, r"\bQ([1-4])\b", 1).try_cast("int"), named)
    year = F.coalesce(*(F.regexp_extract(text, p, 1).try_cast("int") for p in (r"(?i)\bfiscal(?: year)? (20\d{2})\b", r"\bFY ?(20\d{2})\b", r"(?i)\bquarter of (20\d{2})\b")))
    return end, quarter, year


def python_round(value: Column, places: int) -> Column:
    """Half-even rounding of the binary value, as Python rounds: 2.675 gives 2.67."""

    @F.pandas_udf("double")
    def rounded(v: pd.Series) -> pd.Series:
        return v.map(lambda x: None if x is None or x != x else round(x, places))

    return rounded(value.cast("double"))


def pdf_text(content: Column, tool: str = "pdftotext") -> Column:
    """Text of PDF bytes by an external tool on the executors; null where it is not installed or can't read the file."""

    @F.pandas_udf("string")
    def read(raw: pd.Series) -> pd.Series:
        import shutil
        import subprocess

        if not shutil.which(tool):
            return pd.Series([None] * len(raw), dtype="object")

        def one(x):
            done = subprocess.run([tool, "-", "-"], input=bytes(x or b""), capture_output=True, timeout=120)
            return done.stdout.decode("utf-8", "replace") if done.returncode == 0 else None

        return raw.map(one)

    return read(content)
