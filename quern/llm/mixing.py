"""Mixing sources to target weights by Sainte-Lague apportionment; DataFrame functions only.

Targets: water filling. Each source's target is the lesser of `cap` times its
size and a level times its weight, the level being such that targets add up to
`share` of all words; the level follows from sources sorted by cap over weight.

Quotas: words, the smallest equal blocks, go to the sources by the highest
quotients target / (2 k + 1), and a source's words likewise to groups of its shards
and to the shards of each group by size; so small sources get what is theirs. Only seats near the threshold are ranked: with V votes, H seats and n parties
the divisor lies between V / (H + n/2) and V / (H - n/2), which leaves about two
open seats for each party; all below them are certain.

Shards: a source's rows are dealt by the MD5 of doc_id over as many shards as
hold about `shard_rows` rows each, so a source with a third of all rows is many
tasks. GROUP shards are a group and are apportioned in one task as one small row
each; so are the groups of a source, which are few up to 10^11 rows.

Blocks: a shard's documents stand in MD5 order, and their words are cut into
blocks of `block_words`. The shard's quota is taken as whole rounds over all its
blocks and, of a last round, the blocks of least seeded hash, the last of them in
part, so that a shard gives just its quota.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import WORD, own_name, stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 64
SHARD_ROWS = 512
#: Shards of a group.
GROUP = 4096
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _number(text: Column) -> Column:
    """The first 32 bits of a text's MD5 as a long."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _seats(parties: DataFrame, group: list[str], votes: str, house: str, order: list[str]) -> DataFrame:
    """parties with `seats`: Sainte-Lague of `house` seats by `votes` within each group; ties go by `order`."""
    all_of = Window.partitionBy(*group)
    bounded = parties.withColumn("_v", F.sum(votes).over(all_of)).withColumn("_n", F.count("*").over(all_of))
    share = F.when(F.col("_v") > 0, F.col(votes) / F.col("_v")).otherwise(F.lit(0.0))
    low = F.greatest(F.lit(0), F.ceil(share * (F.col(house) - F.col("_n") / 2) - 0.5).cast("long") - 1)
    high = F.greatest(low, F.floor(share * (F.col(house) + F.col("_n") / 2) + 0.5).cast("long") + 1)
    bounded = bounded.withColumn("_low", low).withColumn("_high", F.when(F.col(votes) > 0, high).otherwise(low))
    bounded = bounded.withColumn("_open", F.col(house) - F.sum("_low").over(all_of))
    seats = bounded.withColumn("_k", F.explode_outer(F.expr("if(_high > _low, sequence(_low, _high - 1), null)")))
    quotient = F.col(votes) / (2 * F.col("_k") + 1)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(quotient.desc_nulls_last(), *order, "_k"))
    won = F.col("_k").isNotNull() & (rank <= F.col("_open"))
    seats = seats.withColumn("_won", won.cast("long"))
    keep = [F.first(c).alias(c) for c in parties.columns if c not in {*group, *order}]
    return seats.groupBy(*group, *order).agg(*keep, (F.first("_low") + F.sum("_won")).alias("seats"))


def targets(stats: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """stats (key, source, source_size, source_rows), one row a source, with `target`."""
    by_name = Window.partitionBy("_one").orderBy(F.col("source").asc_nulls_last())
    one = stats.withColumn("_one", F.lit(1)).withColumn("_at", F.row_number().over(by_name))
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.col("_at") - 1) % len(weights) + 1).cast("int"))
    one = one.withColumn("_w", weight).withColumn("_cap", cap * F.col("source_size"))
    one = one.withColumn("_ratio", F.col("_cap") / F.col("_w"))
    rising = Window.partitionBy("_one").orderBy("_ratio", "_at")
    whole = Window.partitionBy("_one")
    below = F.coalesce(F.sum("_cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("_w").over(rising.rowsBetween(0, Window.unboundedFollowing))
    one = one.withColumn("_level", (share * F.sum("source_size").over(whole) - below) / left)
    level = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_at", "_level"))).over(whole)["_level"]
    filled = F.least(F.col("_cap").cast("double"), F.coalesce(level, F.lit(float("inf"))) * F.col("_w"))
    return one.withColumn("target", filled).select("_one", "_at", *stats.columns, "target")


def _names(docs: DataFrame) -> dict[str, str]:
    """Names for the columns that are added in between, none of them in docs."""
    return {x: own_name(docs.columns, f"_q_{x}") for x in ("key", "seed", "size", "whole", "parts")}


def _placed(docs: DataFrame, size: Column, weights, share, cap, block_words, shard_rows, seed) -> tuple[DataFrame, dict[str, str]]:
    """docs with source_size and target (as a struct `mixed`), and by _names() size, whole rounds, and parts: runs (from, n) of words of its chosen blocks."""
    q = _names(docs)
    mixed = own_name([*docs.columns, *q.values()], "_q_mixed")
    shard, end = (own_name(docs.columns, f"_q_{x}") for x in ("shard", "end"))
    rows = docs.select(
        *docs.columns, size.alias(q["size"]), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias(q["key"]),
        F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(q["seed"]))
    stats = rows.groupBy(F.col(q["key"]).alias("key")).agg(
        F.first("source").alias("source"), F.sum(q["size"]).alias("source_size"), F.count("*").alias("source_rows"))
    wanted = targets(stats, weights, share, cap)
    house = F.floor(F.sum("target").over(Window.partitionBy("_one")) + 0.5).cast("long")
    sources = _seats(wanted.withColumn("_house", house), ["_one"], "target", "_house", ["_at"])
    shards = F.ceil(F.col("source_rows") / shard_rows).cast("long")
    sources = stage(sources.select(
        F.col("key").alias(q["key"]), F.struct(F.struct("source_size", "target").alias("out"), "seats", shards.alias("shards")).alias(mixed)))
    dealt = rows.join(sources, q["key"]).withColumn(shard, F.pmod(_number(F.col(q["seed"])), F.col(mixed)["shards"]))
    totals = dealt.groupBy(F.col(q["key"]).alias("key"), F.col(shard).alias("shard")).agg(
        F.sum(q["size"]).alias("words"), F.first(F.col(mixed)["seats"]).alias("house")).withColumn("group", F.floor(F.col("shard") / GROUP))
    totals = stage(totals)
    groups = totals.groupBy("key", "group").agg(F.sum("words").alias("words"), F.first("house").alias("house"))
    of_group = _seats(groups, ["key"], "words", "house", ["group"]).select("key", "group", F.col("seats").alias("house"))
    quotas = _seats(totals.drop("house").join(of_group, ["key", "group"]), ["key", "group"], "words", "house", ["shard"])
    take = F.least(F.col("seats"), cap * F.col("words"))
    whole = F.when(F.col("words") > 0, F.floor(take / F.col("words"))).otherwise(F.lit(0)).cast("long")
    quotas = quotas.withColumn("whole", whole).withColumn("rest", take - F.col("whole") * F.col("words"))
    quotas = stage(quotas.select("key", "shard", "words", "whole", "rest"))
    # The last round takes blocks by their ranks until it has `rest` words: whole ones, then parts of at most two, as the shard's last block is short.
    rank = lambda j: _rank(F.concat_ws("|", F.lit(seed), "key", "shard", j), j)
    last = F.floor((F.col("words") - 1) / block_words).cast("long")
    full = F.floor(F.col("rest") / block_words).cast("int")
    ranked = quotas.where("rest > 0").withColumn("ranks", F.array_sort(F.transform(F.sequence(F.lit(0).cast("long"), last), rank)))
    ranked = ranked.withColumn("first", F.get("ranks", full)).withColumn("second", F.get("ranks", full + 1)).drop("ranks")
    gap = (last + 1) * block_words - F.col("words")
    left = F.col("rest") % block_words + F.when(rank(last) < F.col("first"), gap).otherwise(F.lit(0))
    at_first = F.least(left, block_words - F.when(rank(last) == F.col("first"), gap).otherwise(F.lit(0)))
    ranked = ranked.select("key", "shard", F.struct("first", "second", at_first.alias("n"), (left - at_first).alias("m")).alias("ends"))
    quotas = quotas.join(ranked, ["key", "shard"], "left").select(
        F.col("key").alias(q["key"]), F.col("shard").alias(shard), F.col("whole").alias(q["whole"]), F.col("ends").alias(end))
    order = Window.partitionBy(q["key"], shard).orderBy(F.md5(q["seed"]), "doc_id", q["size"])
    at = own_name(docs.columns, "_q_at")
    placed = dealt.withColumn(at, F.sum(q["size"]).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(stage(quotas), [q["key"], shard])
    b = F.col(at)
    a = b - F.col(q["size"])
    e = F.col(end)
    value = lambda j: _rank(F.concat_ws("|", F.lit(seed), q["key"], shard, j), j)
    width = lambda v: F.when(v < e["first"], block_words).when(v == e["first"], e["n"]).when(v == e["second"], e["m"]).otherwise(0).cast("long")
    ranks = F.transform(F.sequence(F.floor(a / block_words).cast("long"), F.floor((b - 1) / block_words).cast("long")), lambda j: F.struct(j.alias("j"), value(j).alias("v")))
    blocks = F.transform(ranks, lambda x: F.struct((x["j"] * block_words).alias("from"), (x["j"] * block_words + width(x["v"])).alias("to")))
    run = lambda x: F.struct((F.greatest(a, x["from"]) - a).alias("at"), (F.least(b, x["to"]) - F.greatest(a, x["from"])).alias("n"))
    some = F.filter(F.transform(blocks, run), lambda x: x["n"] > 0)
    parts = F.when((F.col(q["size"]) > 0) & e.isNotNull(), some).otherwise(F.array().cast("array<struct<at:bigint,n:bigint>>"))
    return placed.select(*docs.columns, q["size"], q["whole"], parts.alias(q["parts"]), F.col(mixed)["out"].alias(mixed)), q | {"mixed": mixed}


def _rank(name: Column, j: Column) -> Column:
    """A block's place in its shard's seeded order: 28 bits of a hash, then its number, so that no two are equal."""
    return F.shiftleft(F.conv(F.substring(F.md5(name), 1, 7), 16, 10).cast("long"), 35) + j


def _taken(q: dict[str, str]) -> Column:
    return F.col(q["whole"]) * F.col(q["size"]) + F.aggregate(q["parts"], F.lit(0).cast("long"), lambda s, p: s + p["n"])


def mix(
    docs: DataFrame, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP,
    block_words: int = BLOCK_WORDS, shard_rows: int = SHARD_ROWS, seed: str = SEED,
) -> DataFrame:
    """docs (doc_id, source, and text unless size is given) with size, source_size, target, taken: the words that the mix takes of each row.

    Sources go by code point, null last; null and wordless texts have size 0 and
    are never taken; rows with equal doc_id are separate, and equal rows get their
    takes in any order. Columns of docs that have the names of these four are
    replaced. An empty table gives an empty result. Reruns agree.
    """
    size = word_count(F.col("text")) if size is None else size
    placed, q = _placed(docs, size, weights, share, cap, block_words, shard_rows, seed)
    added = {"size": F.col(q["size"]), "source_size": F.col(q["mixed"])["source_size"], "target": F.col(q["mixed"])["target"], "taken": _taken(q).cast("long")}
    return placed.select(*(c for c in docs.columns if c.lower() not in added), *(v.alias(k) for k, v in added.items()))


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP,
    block_words: int = BLOCK_WORDS, shard_rows: int = SHARD_ROWS, seed: str = SEED,
) -> DataFrame:
    """The documents of the mix, with the columns of docs whatever their names: a row for each whole round, and one for the chosen blocks' words.

    n_chars is set anew if it is there. A document whose blocks are all chosen comes as it is.
    """
    placed, q = _placed(docs, word_count(F.col("text")), weights, share, cap, block_words, shard_rows, seed)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = lambda w: F.array_join(F.flatten(F.transform(q["parts"], lambda p: F.slice(w, (p["at"] + 1).cast("int"), p["n"].cast("int")))), " ")
    some = F.aggregate(q["parts"], F.lit(0).cast("long"), lambda s, p: s + p["n"])
    part = F.when(some == 0, F.lit(None)).when(some == F.col(q["size"]), F.col("text")).otherwise(F.get(F.transform(F.array(words), cut), 0))
    texts = F.array_compact(F.array_append(F.array_repeat("text", F.col(q["whole"]).cast("int")), part))
    out = placed.where(F.col(q["size"]) > 0).withColumn(q["parts"], F.explode(texts))
    text = F.col(q["parts"])
    chars = F.length(text).cast("long")
    return out.select(*(text.alias(c) if c == "text" else chars.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))
