"""Secret scans through an incremental blob ledger; DataFrame functions only.

Every version of a text is a blob named by its SHA-256. The ledger holds, for
each blob, the rule versions that have been run on it and the spans they found;
a scan runs only the pairs of blob and rule version that it lacks, once for each
blob however many documents hold it, and findings reach the documents by a join.

Spans without Python: a rule's matches come from regexp_extract_all, the text
between them from split by the same pattern; the running sum of both lengths
gives the positions, in code points. Only blobs with a match are split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import own_name, stage

LEDGER = "blob binary, scanned array<string>, spans array<struct<start:int,kind:int,end:int>>"
SPANS = "array<struct<start:int,kind:int,end:int>>"
CHUNK = 200


@dataclass(frozen=True)
class Rule:
    """A pattern; matches whose `group` has under `least` characters are passed over, as matches that used up their text."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed patterns, in the order in which kinds are listed.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # the runs of 24 and more are just the long matches of [0-9a-f]+
)


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """The rule's spans in a text, by start."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    parts = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), found.alias("match"), kept.alias("kept"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    whole = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("lists"))

    def step(state: Column, part: Column) -> Column:
        begin = state.at + F.length(part.gap)
        end = begin + F.length(F.coalesce(part.match, F.lit("")))
        one = F.array(F.struct(begin.alias("start"), F.lit(number).alias("kind"), end.alias("end"))).cast(SPANS)
        wanted = F.length(part.kept) >= rule.least
        return F.struct(end.alias("at"), F.when(wanted, F.concat(state.spans, one)).otherwise(state.spans).alias("spans"))

    def shifted(state: Column, part: Column) -> Column:
        move = lambda s: F.struct((s.start + state.at).alias("start"), s.kind.alias("kind"), (s.end + state.at).alias("end"))
        return F.struct((state.at + part.at).alias("at"), F.concat(state.lists, F.array(F.transform(part.spans, move))).alias("lists"))

    some = F.transform(_chunks(parts), lambda c: F.aggregate(c, start, step))
    spans = F.aggregate(some, whole, shifted, lambda s: F.flatten(s.lists))
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(SPANS))


def _chunks(items: Column) -> Column:
    """An array in pieces of CHUNK: lists and texts are put together within a piece first, so that long ones cost little more than linear time."""

    def cut(x: Column) -> Column:
        last = F.floor((F.size(x) - 1) / CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(x, k * CHUNK + 1, CHUNK))

    return F.get(F.transform(F.array(items), cut), 0)  # items is bound once, not computed for each piece


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger after all texts of docs: the given rows and one row for each blob that lacked a rule version.

    A null text is the empty blob. Scanning the same texts again with the same
    rules adds no row; a new rule version scans every blob again, by that rule only.
    Many copies of a text meet in one row before they are scanned. Only the column
    text is read; an empty table adds no row.

    With a ledger, digests go first: the blobs that lack a rule are found by their
    digests alone, and only their texts are moved. Where they are few their digests
    are small enough for Spark to send them to the texts, and no other text moves.
    """
    blobs = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", blob_of(F.col("text")))
    names = F.array(*(F.lit(r.name) for r in rules))
    done = F.array().cast("array<string>")
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_set("scanned")).alias("done"))
        lacking = blobs.select("blob").distinct().join(seen, "blob", "left").withColumn("done", F.coalesce("done", done))
        lacking = stage(lacking.where(F.size(F.array_except(names, "done")) > 0))
        blobs = blobs.join(lacking, "blob")
        done = F.col("done")
    blobs = blobs.dropDuplicates(["blob"])
    none = F.array().cast(SPANS)
    spans = [
        F.when(F.array_contains(done, r.name), none).otherwise(_spans(F.col("text"), r, i)) if ledger is not None
        else _spans(F.col("text"), r, i)
        for i, r in enumerate(rules)
    ]
    new = stage(blobs.select("blob", F.array_except(names, done).alias("scanned"), F.array_sort(F.concat(*spans)).alias("spans")))
    return new if ledger is None else ledger.select("blob", "scanned", "spans").unionByName(new)


def _by_blob(ledger: DataFrame) -> DataFrame:
    """(blob, spans) of each blob that has any, over all ledger rows of the blob."""
    rows = ledger.where(F.size("spans") > 0).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("all"))
    new = F.filter("all", lambda s, i: (i == 0) | (s != F.get("all", i - 1)))  # array_distinct compares all pairs of structs
    return stage(rows.select("blob", new.alias("spans")))


def findings(docs: DataFrame, ledger: DataFrame, name: str = "secret_spans") -> DataFrame:
    """docs with a column of the given name: the sorted spans (start, kind number, end) of each row's text; none for null and empty texts."""
    blob = own_name([*docs.columns, name], "blob")
    found = _by_blob(ledger).select(F.col("blob").alias(blob), F.col("spans").alias(name))
    joined = docs.withColumn(blob, blob_of(F.col("text"))).join(found, blob, "left")
    return joined.select(*docs.columns, F.coalesce(name, F.array().cast(SPANS)).alias(name))


def joined_spans(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s.kind), s.start, s.end)), ",")


def redact(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """docs with each stretch of secret characters replaced by a mark; same columns whatever their names, n_chars set anew if it is there.

    Repeated rows are changed alike; null texts stay null.
    """
    spans_of = own_name(docs.columns, "secret_spans")
    found = findings(docs, scan(docs, ledger, rules), spans_of)
    text = F.col("text")
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("outs"))

    def piece(state: Column, spans: Column) -> Column:
        """The text from state.at to the last end of some spans, without their characters."""
        base = state.at
        stop = F.greatest(base, F.array_max(F.transform(spans, lambda s: s.end)))

        def cut(part: Column) -> Column:
            def step(t: Column, s: Column) -> Column:
                a, b = s.start - base, s.end - base
                before = F.concat(t.out, F.substring(part, t.at + 1, a - t.at), F.lit(mark))
                return F.struct(F.greatest(t.at, b).alias("at"), F.when(a >= t.at, before).otherwise(t.out).alias("out"))

            return F.aggregate(spans, begin, step, lambda t: t.out)

        out = F.get(F.transform(F.array(F.substring(text, base + 1, stop - base)), cut), 0)
        return F.struct(stop.alias("at"), F.concat(state.outs, F.array(out)).alias("outs"))

    rest = lambda s: F.concat(F.array_join(s.outs, ""), F.substring(text, s.at + 1, F.length(text)))
    clean = F.when(F.size(spans_of) > 0, F.aggregate(_chunks(F.col(spans_of)), whole, piece, rest)).otherwise(text)
    out = found.withColumn("text", clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans_of) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
