"""Hot keys, large registries and plan shapes: the same rows as brute force, and no hidden multiplication."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from indicatrix import load_registry
from indicatrix.operators import latest as T, lists as L, registry as R, reshape as S
from indicatrix.plans.collect import combine
from indicatrix.schemas import REGISTRY_SCHEMA, UNIFIED_SCHEMA

from fixtures import registry, rows


def wide_registry(spark, n=300, **bounds):
    data = [(f"Society {i}", f"Land {i}", f"L{i:03d}", None, "R", f"D{i}", [f"S-{i}"], [f"Realm of {i}"]) for i in range(n)]
    return load_registry(spark.createDataFrame(data, REGISTRY_SCHEMA), **bounds)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_names(spark):
    """A third of the rows share one name, a tenth have none, some are unknown."""
    return spark.range(20_000).selectExpr(
        "id", "case when id % 3 = 0 then ' land  7' when id % 10 = 1 then null when id % 11 = 2 then concat('Lost ', id % 5) "
              "else concat('REALM OF ', id % 300) end as name")


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 10}])
def test_hot_name_resolves_like_a_dictionary(spark, bounds):
    known = {**{f"land {i}": f"Land {i}" for i in range(300)}, **{f"realm of {i}": f"Land {i}" for i in range(300)}}
    df = hot_names(spark)
    expected = Counter()
    for r in df.collect():
        tidy = None if r["name"] is None else " ".join(r["name"].split())
        expected[tidy and known.get(tidy.lower(), tidy)] += 1
    out = R.resolve_names(df, wide_registry(spark, **bounds), "name", "country", errors="ignore")
    assert {r["name"]: r["n"] for r in out.groupBy("name").agg(F.count("*").alias("n")).collect()} == expected


def test_build_side_follows_the_measured_size(spark):
    df = hot_names(spark)
    small = R.enrich(df, wide_registry(spark), "name", "country", clean=True)
    assert "BroadcastHashJoin" in plan(small) and "Exchange hashpartitioning" not in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = R.enrich(df, wide_registry(spark, max_rows=10), "name", "country", clean=True)
        assert "BroadcastHashJoin" not in plan(large) and "SortMergeJoin" in plan(large)
        assert rows(large.groupBy("country").count()) == rows(small.groupBy("country").count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("bounds", [{}, {"max_map_keys": 10}, {"max_rows": 10}])
def test_hot_list_resolves_like_a_dictionary(spark, bounds):
    df = spark.range(6_000).selectExpr(
        "id", "case when id % 3 = 0 then array('land 1', 'Realm of 2', 'land 1') when id % 7 = 1 then array() "
              "when id % 7 = 2 then null else array(concat('Land ', id % 290), 'nowhere') end as country")
    reg = wide_registry(spark, **bounds)
    out = L.enrich_list(L.resolve_list(df, reg, "country", errors="ignore"), reg, "country")
    got = {r["id"]: (r["country"], r["iso3"]) for r in out.collect()}
    assert len(got) == 6_000
    for r in df.collect():
        if r["country"] is None:
            want = (None, None)
        elif not r["country"]:
            want = ([], [])
        elif len(r["country"]) == 3:
            want = (["Land 1", "Land 2", "Land 1"], ["L001", "L002", "L001"])
        else:
            number = int(r["country"][0].split()[1])
            want = ([f"Land {number}", "nowhere"], [f"L{number:03d}", "nowhere"])
        assert got[r["id"]] == want


def test_small_registry_lists_are_not_shuffled(spark):
    df = spark.createDataFrame([(["Land 1"],)], "country array<string>")
    shape = L.resolve_list(df, wide_registry(spark), "country")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in shape and "explode" not in shape.split("Scalar")[0].split("scalar")[0]


def test_union_of_datasets_needs_one_shuffle_for_latest(spark):
    part = spark.createDataFrame([("E", "C", "I", "R", "i", "1", 2020, "", "", "d1")], UNIFIED_SCHEMA)
    parts = [part, part.withColumn("dataset", F.lit("d2")), part.withColumn("year", F.lit(2021))]
    df = combine(parts, latest=True)
    assert plan(df).count("Exchange hashpartitioning") == 1
    assert rows(df, "dataset", "year") == [("d1", 2021), ("d2", 2020)]


def test_filter_on_the_key_goes_below_the_window(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("cast(id % 5 as string) as entity_name", "'i' as indicator", "1 as year", "id as value").write.parquet(path)
    df = T.latest_indicators(spark.read.parquet(path)).where("entity_name = '3'")
    assert "EqualTo(entity_name,3)" in plan(df)


def test_unused_columns_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("'AFG' as code", "id as a", "id as b", "id as c").write.parquet(path)
    df = R.enrich(spark.read.parquet(path), registry(spark), "code", "iso3").select("country", "a")
    assert "ReadSchema: struct<code:string,a:bigint>" in plan(df)
    melted = S.melt(spark.read.parquet(path), ["code"], ["a", "b"]).where("indicator = 'a'")
    assert "c:bigint" not in plan(melted)


def test_rows_that_cannot_match_are_not_joined(spark, tmp_path):
    """98 of 100 rows hold no ids: they pass the joins by, and the rows of the others are spread whatever they share."""
    path = str(tmp_path / "t")
    spark.range(20_000).selectExpr("id", "case when id % 100 < 2 then 'a' else 'b' end as kind",
                                   "case when id % 100 = 0 then concat('X', id % 3, ', X9') when id % 7 > 0 then 'X1' end as v").write.parquet(path)
    df = spark.read.parquet(path)
    ids = spark.createDataFrame([(f"X{i}", f"Name {i}") for i in range(3)], "entity_id string, name string")
    out = L.resolve_id_text(df, wide_registry(spark), "v", F.col("kind") == "a", id_names=ids)
    shape = plan(out)
    # both the lists' rows and the distinct lists come from the filtered scan; the rest is one scan without exchange
    joined, rest = shape.split("FileScan")[1:-1], shape.split("FileScan")[-1]
    assert "Union" in shape and joined and all("EqualTo(kind,a)" in scan for scan in joined if "kind" in scan)
    assert "EqualTo(kind,a)" not in rest and "Exchange" not in shape[shape.rindex("Filter"):]
    got = {r["id"]: r["v"] for r in out.collect()}
    assert len(got) == 20_000
    for r in df.collect():
        want = r["v"]
        if r["kind"] == "a" and want is not None:
            want = ", ".join(f"Name {t[1:]}" if t != "X9" else t for t in want.split(", "))
        assert got[r["id"]] == want


@pytest.mark.parametrize("join", ["broadcast", "shuffle"])
def test_null_keys_are_dealt_out(spark, join):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1 if join == "shuffle" else 10_000_000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(8_000).selectExpr("id", "case when id % 10 = 0 then cast(id % 50 as int) end as k",
                                           "case when id % 10 = 0 then concat('D', id % 50) end as code")
        pairs = spark.range(50).selectExpr("cast(id as int) as key", "concat('v', id) as value")
        mapped = R.map_ids(df, pairs, "k", "out", "key", "value")
        assert {r["id"]: r["out"] for r in mapped.collect()} == {i: f"v{i % 50}" if i % 10 == 0 else None for i in range(8_000)}
        reg = wide_registry(spark, **({"max_rows": 10} if join == "shuffle" else {}))
        named = R.resolve_ids(df, reg, "code", "out")
        assert {r["id"]: r["out"] for r in named.collect()} == {i: f"Society {i % 50}" if i % 10 == 0 else None for i in range(8_000)}
        if join == "shuffle":
            sizes = [r["count"] for r in mapped.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2] and len(sizes) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
