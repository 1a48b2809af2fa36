"""The database's constraints and views, and the overlap of patterns."""

import fnmatch
from itertools import product

import pytest

from quern.operators import database, globs, runs
from quern.operators.audits import GateClosed


def observations(spark, *rows):
    return spark.createDataFrame([(i, e, "revenue", "actual", 0, s, "https://a", "{}") for i, e, s in rows],
                                 "id string, entity_id string, concept_id string, value_type string, revision int, source_id string, source_url string, raw_json string")


def test_a_dangling_key_leaves_the_old_views(spark, tmp_path):
    entities = spark.createDataFrame([("e", "E", "{}", "extra")], "id string, name string, raw_json string, more string")
    sources = spark.createDataFrame([("s", "https://a", "{}")], "id string, url string, raw_json string")
    good = {"entities": entities, "sources": sources, "observations": observations(spark, ("1", "e", "s"), ("2", "e", None))}
    first = database.publish(spark, good, "quern_db", f"{tmp_path}/db")
    shown = lambda: {r.id for r in spark.table("quern_db.observations").collect()}
    assert shown() == {"1", "2"} and spark.table("quern_db.entities").columns[:2] == ["id", "name"] and spark.table("quern_db.audit_issues").count() == 0
    for rows, why in (((("3", "nobody", None),), "DANGLING_REFERENCE"), ((("3", "e", "none"),), "source_id"), ((("3", "e", None), ("3", "e", None)), "DUPLICATE_KEY"), (((None, "e", None),), "MISSING_KEY"), ((("3", None, None),), "entity_id MISSING_VALUE")):
        with pytest.raises(database.Refused, match=why):
            database.publish(spark, {**good, "observations": observations(spark, *rows)}, "quern_db", f"{tmp_path}/db")
        assert shown() == {"1", "2"}
    assert database.publish(spark, {**good, "observations": observations(spark, ("9", "e", "s"))}, "quern_db", f"{tmp_path}/db") != first and shown() == {"9"}
    with pytest.raises(KeyError):
        database.violations({"other": entities})
    spark.sql("DROP DATABASE quern_db CASCADE")


def test_pattern_overlap_agrees_with_all_short_paths():
    patterns = ["*", "a*", "*b", "a?", "?", "", "ab", "[ab]", "[!a]*", "a[!b]", "*a*", "[a-b]b", "b*a", "[", "a[", "**", "[]]", "x*"]
    paths = ["".join(p) for n in range(5) for p in product("ab[x]", repeat=n)]
    matched = {p: {x for x in paths if fnmatch.fnmatchcase(x, p)} for p in patterns}
    for one, other in product(patterns, repeat=2):
        assert globs.overlap(one, other) == bool(matched[one] & matched[other]), (one, other)


def test_roots_that_overlap():
    roots = [("data/*.json", "a/b"), ("data/latest_*", "a/b/c"), ("docs/*.md", "x"), ("d?cs/[r]*", "ab")]
    assert globs.overlapping(roots) == [("destination", "a/b", "a/b/c"), ("path", "data/*.json", "data/latest_*"), ("path", "docs/*.md", "d?cs/[r]*")]


def test_strict_runs_and_orders(spark):
    states = spark.createDataFrame([("sia_wsts", "ok"), ("jquants_v2", "error"), ("kofia", "disabled_missing_secret")], "source string, status string")
    runs.strict(states, ["sia_wsts", "kofia"])
    with pytest.raises(GateClosed, match="jquants_v2"):
        runs.strict(states, ["sia_wsts", "jquants_v2"])
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("9",), ("10",), (" 2.5 ",), ("x",), (None,)], "v string")
    assert [r.v for r in rows.orderBy(*runs.numeric_order(F.col("v"))).collect()][:3] == ["10", "9", " 2.5 "]
    assert [r.v for r in rows.orderBy(*runs.numeric_order(F.col("v"), False)).collect()][:3] == [" 2.5 ", "9", "10"]


def test_a_failed_source_keeps_its_past_and_private_rows_stay_out(spark):
    from pyspark.sql import functions as F

    schema = "k string, source_id string, n int, v int"
    past = spark.createDataFrame([("a", "sia", 1, 1), ("b", "kofia", 1, 2), ("d", runs.DERIVED, 1, 3), ("e", runs.DERIVED, 1, 4)], schema)
    new = spark.createDataFrame([("a", "sia", 2, 10), ("p", "jquants_v2_bars", 2, 100)], schema)
    derive = lambda of: of.agg(F.sum("v").alias("v")).select(F.lit("d").alias("k"), F.lit(runs.DERIVED).alias("source_id"), F.lit(2).alias("n"), F.col("v").cast("int").alias("v"))
    got = runs.observed(past, [new, new.limit(0)], ["k", "source_id"], ["n"], derive).collect()
    assert {(r.k, r.v) for r in got} == {("a", 10), ("b", 2), ("d", 112), ("e", 4)}
