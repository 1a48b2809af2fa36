"""Small shapes of rows: projections of records, enumerations, orders, flags, roll-ups, requests, reuse of evidence."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.scalars import days, filing_url, number
from quern.operators.bands import free_name

#: Fixed names of a bar's figures in a record: adjusted ones first.
BAR = {
    "open": ("AdjO", "O", "AdjustmentOpen", "Open"), "high": ("AdjH", "H", "AdjustmentHigh", "High"), "low": ("AdjL", "L", "AdjustmentLow", "Low"),
    "close": ("AdjC", "C", "AdjustmentClose", "Close"), "volume": ("AdjVo", "Vo", "AdjustmentVolume", "Volume"),
}
#: Fixed tags that report the same thing.
REVENUE_TAGS = ("Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax", "SalesRevenueNet")
CAPEX_TAGS = ("PaymentsToAcquirePropertyPlantAndEquipment", "PaymentsForAdditionsToPropertyPlantAndEquipment", "PaymentsToAcquireProductiveAssets")
#: Fixed order of runway bands, worst first.
BAND_ORDER = ("under_two_years", "two_to_five_years", "five_years_plus", "self_funding")


def bars(rows: DataFrame, record: str) -> DataFrame:
    """(date, code, open, high, low, close, volume) of JSON records; those without date, code or close are left out, (date, code) is unique."""
    named = ["Date", "Code", *(n for names in BAR.values() for n in names)]
    parsed = rows.select(F.from_json(record, ", ".join(f"{n} string" for n in named)).alias("_j"))  # once a record
    text = lambda k: F.trim(F.coalesce(F.col("_j")[k], F.lit("")))
    out = parsed.select(text("Date").alias("date"), text("Code").alias("code"), *(F.coalesce(*(number(F.col("_j")[n]) for n in names)).alias(c) for c, names in BAR.items()))
    good = out.where((F.col("date") != "") & (F.col("code") != "") & F.col("close").isNotNull())
    return good.groupBy("date", "code").agg(F.min(F.struct(*BAR)).alias("_b")).select("date", "code", "_b.*")


def allowed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns of an allow-list that are there, in its order."""
    return df.select(*(c for c in columns if c in df.columns))


def projection(df: DataFrame, key: str, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A consumer's view: its keys only, its columns only."""
    return allowed(df.join(wanted.select(key).distinct(), key, "left_semi"), columns)


def filing_records(facts: DataFrame, base: str) -> DataFrame:
    """Filing facts as records: source_url, duration_days, and where each comes from as a struct."""
    source = F.struct("taxonomy", "concept", "accession", "form", F.col("filed").alias("filed_at"))
    return facts.withColumns({
        "source_url": filing_url(base, F.col("cik"), F.col("accession")), "duration_days": days(F.col("period_start"), F.col("period_end")), "provenance": source})


def derived(facts: DataFrame, value: Column, text: str) -> DataFrame:
    """facts with a computed value and the words that say how it was made."""
    return facts.withColumns({"value": value, "value_type": F.lit("derived"), "derivation": F.lit(text)})


def flags(conditions: dict[str, Column]) -> Column:
    """The names of the conditions that hold, in their order."""
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in conditions.items())))


def equivalent_tags(tags: Iterable[str], annual: bool, classes: Sequence[tuple[str, ...]] = (CAPEX_TAGS,), single: Sequence[tuple[str, ...]] = (REVENUE_TAGS,)) -> list[str]:
    """The tags to look for: in annual data a class of equal tags is taken whole, a `single` one only for a list of one."""
    wanted = list(tags)
    more: tuple[str, ...] = ()
    if annual and wanted:
        more = next((c for c in single if len(wanted) == 1 and wanted[0] in c), ()) or next((c for c in classes if set(wanted) <= set(c)), ())
    return list(dict.fromkeys([*wanted, *more]))


def carries_accession(facts: Column, accession: Column) -> Column:
    """Whether any observation of a nested map taxonomy > concept > units > list is of the accession."""
    of_list = lambda lists: F.exists(F.flatten(F.map_values(lists)), lambda f: f["accn"] == accession)
    of_concept = lambda concepts: F.exists(F.map_values(concepts), lambda c: of_list(c["units"]))
    return F.coalesce(F.exists(F.map_values(facts), of_concept), F.lit(False))


def filtered(companies: DataFrame, text: str = "", role: str = "", kind: str = "") -> DataFrame:
    """Companies whose name or ticker holds a text, of a role and a class; an empty choice takes all."""
    has = F.contains(F.lower(F.concat_ws(" ", "name", "ticker")), F.lit(text.strip().lower()))
    return companies.where(has & (F.lit(role == "") | (F.col("role") == role)) & (F.lit(kind == "") | (F.col("class") == kind)))


def required_ids(documents: DataFrame, key: str) -> DataFrame:
    """Distinct ids of rows (key, status, issues) of documents that passed without an issue."""
    return documents.where((F.col("status") == "PASS") & (F.coalesce("issues", F.lit(0)) == 0) & F.col(key).isNotNull()).select(key).distinct()


def requests_for(universe: DataFrame, templates: dict[str, str], batch: str) -> DataFrame:
    """One request of each template for each company (company), and one batch request for all; templates are few and explode from a row."""
    listed = F.array(*(F.struct(F.lit(n).alias("operation"), F.lit(p).alias("path")) for n, p in templates.items()))
    each = universe.select("company", F.explode(listed).alias("_t")).select("company", "_t.operation", F.replace(F.col("_t.path"), F.lit("{company}"), F.col("company")).alias("path"))
    one = universe.sparkSession.createDataFrame([(None, "master", batch)], "company string, operation string, path string")
    return each.unionByName(one)


def rolled_up(universe: DataFrame, rows: DataFrame, key: str, status: str) -> DataFrame:
    """One row: companies of the universe, those with rows and without, and a map of the rows' states to their number."""
    counts = rows.join(universe.select(key).distinct(), key, "left_semi").groupBy(key, status).agg(F.count("*").alias("n"))
    per = counts.groupBy(key).agg(F.sum("n").alias("rows"))
    found = universe.select(key).distinct().join(per, key, "left").agg(
        F.count("*").alias("companies"), F.count("rows").alias("covered"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    states = counts.groupBy(status).agg(F.sum("n").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(status, "n")))).alias("states"))
    return found.withColumn("missing", F.col("companies") - F.col("covered")).join(F.broadcast(states), F.lit(True), "left")  # one row each


def manifest_totals(files: DataFrame, root: Column) -> DataFrame:
    """(root, files, size_bytes): how many files lie under each root, and their bytes."""
    return files.groupBy(root.alias("root")).agg(F.count("*").alias("files"), F.sum("size_bytes").alias("size_bytes"))


def enumerated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value): the distinct values of each column, nulls left out; rows, not one list."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))).alias("_v")).select("_v.*")
    return long.where(F.col("value").isNotNull()).distinct()


def evidence_ids(facts: DataFrame, keys: Sequence[str], id_: str, order: str) -> DataFrame:
    """(keys, evidence_ids): the ids behind each key, in order."""
    return facts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, id_))), lambda s: s[id_]).alias("evidence_ids"))


def text_order(columns: Sequence[str]) -> list[Column]:
    """Ascending by several columns, null as the empty text."""
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).asc() for c in columns]


def band_order(band: Column, runway: Column) -> list[Column]:
    """Worst band first, unknown bands last; within a band the shortest runway, none last."""
    rank = F.coalesce(*(F.when(band == b, i) for i, b in enumerate(BAND_ORDER)), F.lit(len(BAND_ORDER)))
    return [rank.asc(), runway.asc_nulls_last()]


def newest_filings(filings: DataFrame, keys: Sequence[str], forms: Sequence[str], most: int = 12) -> DataFrame:
    """The newest filings of some forms of each company, by filing date, then accession."""
    w = Window.partitionBy(*keys).orderBy(F.desc("filing_date"), F.desc("accession"))
    at = free_name(filings.columns, "_at")
    return filings.where(F.col("form").isin(*forms)).withColumn(at, F.row_number().over(w)).where(F.col(at) <= most).drop(at)


def compare_list(picks: DataFrame, key: str, item: str, at: str, most: int = 4) -> DataFrame:
    """A user's list of picks: each item once, where it first stands; the first `most`, in order."""
    once = picks.groupBy(key, item).agg(F.min(at).alias(at))
    w = Window.partitionBy(key).orderBy(at, item)
    return once.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def bar_height(value: Column, most: Column, full: int = 100, least: int = 3) -> Column:
    """A chart's bar: the share of the greatest value in percent, at least 3 so that it shows."""
    return F.greatest(F.lit(float(least)), F.round(F.coalesce(F.try_divide(value, most), F.lit(0.0)) * full, 1))


def reusable(events: DataFrame, evidence: DataFrame) -> DataFrame:
    """events with `reused`: whether earlier evidence of the same event, company and form passed and has a digest and a body."""
    shape = F.coalesce(F.col("source_content_sha256"), F.lit("")).rlike("^[0-9a-f]{64}$") & (F.coalesce("source_content_bytes", F.lit(0)) > 0)
    keys = ["event_id", "company_id", "document_type"]
    good = evidence.where((F.col("status") == "PASS") & shape).select(*keys).distinct().withColumn("reused", F.lit(True))
    return events.join(good, keys, "left").withColumn("reused", F.coalesce("reused", F.lit(False)))


def quarters_from_filings(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, fiscal_year, fiscal_period, period_end, value, formula) from cumulative 10-Q facts and their 10-K.

    facts: keys, form, period_start, period_end, value, fiscal_year, filed,
    accession. Later filings repeat a fact as a comparative, so of each period and
    form the first filed counts, then the least accession; facts that lack a period,
    value, filing date or accession take no part. A year is a 10-K fact of 300 to
    400 days with just three 10-Q facts of 60 to 300 days from the same start that
    end before it. Years in which a quarter would be negative are left out.
    """
    there = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in ("period_start", "period_end", "value", "filed", "accession")))
    first = F.min_by(F.struct("value", "fiscal_year"), F.struct("filed", "accession")).alias("_first")
    facts = facts.where(F.col("form").isin("10-K", "10-Q") & there).groupBy(*keys, "form", "period_start", "period_end").agg(first)
    facts = facts.select(*keys, "form", "period_start", "period_end", "_first.*")
    length = days(F.col("period_start"), F.col("period_end"))
    year = facts.where((F.col("form") == "10-K") & length.between(300, 400)).select(
        *keys, "period_start", F.col("period_end").alias("_end"), F.col("value").alias("_all"), F.coalesce("fiscal_year", F.year("period_end")).alias("fiscal_year"))
    parts = facts.where((F.col("form") == "10-Q") & length.between(60, 300)).groupBy(*keys, "period_start").agg(
        F.collect_list(F.struct("period_end", "value")).alias("_parts"))
    j = year.join(parts, [*keys, "period_start"]).withColumn("_q", F.array_sort(F.filter("_parts", lambda p: p["period_end"] < F.col("_end"))))
    at = lambda i: F.get("_q", i)["value"]
    named = (("Q1", 0, lambda: at(0), "Q1 year-to-date"), ("Q2", 1, lambda: at(1) - at(0), "Q2 year-to-date - Q1 year-to-date"),
             ("Q3", 2, lambda: at(2) - at(1), "Q3 year-to-date - Q2 year-to-date"), ("Q4", None, lambda: F.col("_all") - at(2), "FY - Q3 year-to-date"))
    four = F.array(*(F.struct(
        F.lit(n).alias("fiscal_period"), (F.col("_end") if i is None else F.get("_q", i)["period_end"]).alias("period_end"), v().alias("value"), F.lit(t).alias("formula")) for n, i, v, t in named))
    whole = j.where(F.size("_q") == 3).withColumn("_four", four).where(F.forall("_four", lambda q: q["value"] >= 0))
    return whole.select(*keys, "fiscal_year", F.explode("_four").alias("_f")).select(*keys, "fiscal_year", "_f.*")


#: Fixed bands of reported durations: a quarter, two quarters, three, and a year.
REPORTED = {"quarter": (70, 110), "half": (150, 220), "nine": (240, 300), "annual": (300, 380)}


def quarters_by_band(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, fiscal_year, fiscal_period, period_start, period_end, value, value_type) of facts.

    facts: keys, fiscal_year, fiscal_period, period_start, period_end, filed,
    accession, value. A directly reported quarter is preferred; else the later less
    the earlier cumulative value, beginning the day after the earlier one ends. Q4
    is the year less three quarters. Of several facts of a period and band the last
    ended counts, then the last filed, then the greatest accession: a comparative of
    an earlier year never wins. A quarter that two fiscal years give is one row, of
    the earlier year.
    """
    length = days(F.col("period_start"), F.col("period_end"))
    fact = F.struct("period_end", "filed", "accession", "period_start", "value")
    pick = lambda fp, band: F.max(F.when((F.col("fiscal_period") == fp) & length.between(*REPORTED[band]), fact))
    wide = facts.groupBy(*keys, "fiscal_year").agg(
        pick("Q1", "quarter").alias("q1"), pick("Q2", "quarter").alias("q2"), pick("Q2", "half").alias("h2"), pick("Q3", "quarter").alias("q3"),
        pick("Q3", "nine").alias("n3"), pick("FY", "quarter").alias("q4"), pick("FY", "annual").alias("fy"))

    def one(name, direct, later=None, earlier=None):
        d = F.col(direct)
        whole = F.struct(F.lit(name).alias("fiscal_period"), d["period_start"].alias("period_start"), d["period_end"].alias("period_end"), d["value"].alias("value"), F.lit("reported_quarter").alias("value_type"))
        if later is None:
            return F.when(d.isNotNull(), whole)
        a, b = F.col(later), F.col(earlier)
        made = F.struct(F.lit(name).alias("fiscal_period"), F.date_add(b["period_end"], 1).alias("period_start"), a["period_end"].alias("period_end"), (a["value"] - b["value"]).cast(facts.schema["value"].dataType).alias("value"),
                        F.lit("derived_from_reported_periods").alias("value_type"))
        return F.when(d.isNotNull(), whole).when(a.isNotNull() & b.isNotNull(), made)

    rows = F.array_compact(F.array(one("Q1", "q1"), one("Q2", "q2", "h2", "q1"), one("Q3", "q3", "n3", "h2"), one("Q4", "q4", "fy", "n3")))
    long = wide.select(*keys, "fiscal_year", F.explode(rows).alias("_q")).select(*keys, "fiscal_year", "_q.*")
    rest = ["fiscal_year", "fiscal_period", "value", "value_type"]
    # Q4 is made last, so of one year's equal periods it stays
    once = long.groupBy(*keys, "period_start", "period_end").agg(F.max_by(F.struct(*rest), F.struct(-F.col("fiscal_year"), F.col("fiscal_period"))).alias("_q"))
    return once.select(*keys, "_q.fiscal_year", "_q.fiscal_period", "period_start", "period_end", "_q.value", "_q.value_type")


#: Fixed concepts of sequential changes, and the code of a missing guidance for each.
KPI_CHANGES = {"nand_asp_change_qoq": "nand_asp_guidance_not_disclosed", "nand_bit_shipments_change_qoq": "nand_bit_guidance_not_disclosed"}


def kpi_audit(rows: DataFrame) -> DataFrame:
    """Issues (severity, code, record_id, entity_id, period_end) of KPI rows.

    rows: id, value_type, concept_id, reported_text, quality_flags,
    normalization_method, entity_id, period_end. Actuals are those of the sequential
    changes. There must be some; each needs its text, and the method if its band was
    normalised: errors of the record. An entity's period with an actual but no
    company guidance of its concept is one warning, however many rows it has.
    """
    actual = rows.where((F.col("value_type") == "actual") & F.col("concept_id").isin(*KPI_CHANGES))
    text = lambda v=None: F.lit(v).cast("string")
    day = F.lit(None).cast(rows.schema["period_end"].dataType)
    entity = F.lit(None).cast(rows.schema["entity_id"].dataType)
    none = actual.agg(F.count("*").alias("n")).where("n = 0").select(
        text("error").alias("severity"), text("nand_kpi_actuals_missing").alias("code"), text().alias("record_id"), entity.alias("entity_id"), day.alias("period_end"))
    codes = F.array_compact(F.array(
        F.when(F.coalesce("reported_text", F.lit("")) == "", "nand_reported_text_missing"),
        F.when(F.array_contains("quality_flags", "normalized_qualitative_band") & (F.coalesce("normalization_method", F.lit("")) == ""), "nand_normalization_policy_missing")))
    each = actual.select(text("error").alias("severity"), F.explode(codes).alias("code"), F.col("id").cast("string").alias("record_id"), entity.alias("entity_id"), day.alias("period_end"))
    keys = ["entity_id", "period_end", "concept_id"]
    view = rows.where(F.col("concept_id").isin(*KPI_CHANGES) & F.col("period_end").isNotNull()).groupBy(*keys).agg(
        F.bool_or(F.col("value_type") == "actual").alias("actual"), F.bool_or(F.col("value_type") == "company_guidance").alias("guided"))
    code = F.coalesce(*(F.when(F.col("concept_id") == c, F.lit(x)) for c, x in KPI_CHANGES.items()))
    silent = view.where(F.col("actual") & ~F.coalesce("guided", F.lit(False))).select(text("warning").alias("severity"), code.alias("code"), text().alias("record_id"), "entity_id", "period_end")
    return none.unionByName(each).unionByName(silent)
