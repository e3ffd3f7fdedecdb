import pytest
from pyspark.sql import Observation, functions as F

from indicatrix.operators import lists as L, registry as R

from fixtures import registry, rows


@pytest.fixture(params=["small", "large"])
def reg(spark, request):
    """The same registry below and above the broadcast bounds: both ways must agree."""
    return registry(spark) if request.param == "small" else registry(spark, max_rows=2, max_map_keys=1)


def test_measured_bounds(spark):
    assert registry(spark).broadcastable and registry(spark).fits_map
    big = registry(spark, max_rows=2)
    assert not big.broadcastable and not big.fits_map
    assert not registry(spark, max_map_keys=3).fits_map


def test_resolve_names(spark, reg):
    df = spark.createDataFrame(
        [(1, " afghan  RED crescent society "), (2, "Zimbabwe rc"), (3, "No  Such"), (4, None)], "id int, n string")
    out = R.resolve_names(df, reg, "n", errors="ignore", flag="ok")
    assert rows(out, "id", "n", "ok") == [
        (1, "Afghan Red Crescent", True), (2, "Zimbabwe Red Cross Society", True), (3, "No Such", False),
        (4, None, False)]


def test_policies(spark, reg):
    df = spark.createDataFrame([("Nowhere",), ("Albania",), (None,)], "c string")
    with pytest.raises(Exception, match="Unknown c value in data: Nowhere"):
        R.resolve_names(df, reg, "c", "country").collect()
    with pytest.raises(ValueError):
        R.resolve_names(df, reg, "c", "country", errors="shout")
    seen = Observation("seen")
    R.resolve_names(df, reg, "c", "country", "warn", seen).collect()
    assert seen.get == {"unknown_rows": 1, "null_rows": 1}
    assert rows(R.unknown_values(df, reg, "c", "country")) == [("Nowhere", 1)]
    with pytest.raises(ValueError):
        R.resolve_names(df, reg, "c", "region")


def test_lookup_ignores_aliases(spark, reg):
    df = spark.createDataFrame([("ALBANIA",), ("Republic of Albania",), (None,)], "c string")
    assert rows(R.lookup(df, reg, "c", "country", "iso3")) == [
        ("ALBANIA", "ALB"), ("Republic of Albania", None), (None, None)]
    assert rows(R.country_to_entity(df.where("c is not null"), reg, "c"), "entity_name") == [("Albanian Red Cross",)] * 2


def test_enrich_keeps_rows_and_two_hop(spark, reg):
    df = spark.createDataFrame([("uto",), ("ZWE",), ("XXX",)], "code string")
    plain = rows(R.enrich(df, reg, "code", "iso3", errors="ignore"), "code", "entity_name", "country", "iso3")
    assert plain == [("XXX", None, None, None), ("ZWE", "Zimbabwe Red Cross Society", "Zimbabwe", "ZWE"),
                     ("uto", None, "Utopia", "UTO")]
    hop = rows(R.enrich(df, reg, "code", "iso3", errors="ignore", require_entity=True), "code", "country")
    assert hop == [("XXX", None), ("ZWE", "Zimbabwe"), ("uto", None)]


def test_one_join_for_all_attributes(spark):
    df = spark.createDataFrame([("ZWE",)], "code string")
    plan = R.enrich(df, registry(spark), "code", "iso3")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1


REPEATED = [("A Society", "Aland", "AAA", "A1", "R", "1", ["Shared Name"], ["Old Land"]),
            ("B Society", "aland", "BBB", "B1", "R", "2", ["shared name"], []),
            ("C Society", "Cland", "CCC", "C1", "S", "3", [], ["Sea"]), ("C Society", "Cland", "CCC", "C1", "S", "3", [], ["Coast"])]


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0}, {"max_map_keys": 0}, {"max_bytes": 0}])
def test_repeated_rows_and_shared_keys_give_one_row(spark, bounds):
    """On every lookup path: broadcast, shuffled, in the row, and joined lists."""
    from indicatrix import load_registry
    from indicatrix.schemas import REGISTRY_SCHEMA
    reg = load_registry(spark.createDataFrame(REPEATED * 2, REGISTRY_SCHEMA), **bounds)
    df = spark.createDataFrame([("Aland",), ("cland",), (None,), (None,)], "c string")
    assert rows(R.lookup(df, reg, "c", "country", "iso3")) == [("Aland", "BBB"), ("cland", "CCC"), (None, None), (None, None)]
    names = spark.createDataFrame([("shared name",), ("C society",), (None,)], "c string")
    assert rows(R.resolve_names(names, reg, "c")) == [("B Society",), ("C Society",), (None,)]
    places = spark.createDataFrame([(["sea", "coast", "Aland", "sea"],), ([],), (None,)], "c array<string>")
    assert rows(L.resolve_list(places, reg, "c")) == [(None,), (["Cland", "Cland", "aland", "Cland"],), ([],)]
    found = L.enrich_list(L.resolve_list(places, reg, "c"), reg, "c", targets=("iso3",))
    assert rows(found, "iso3") == [(None,), (["CCC", "CCC", "BBB", "CCC"],), ([],)]
    ids = spark.createDataFrame([("1, sea;3",)], "v string")
    assert rows(L.resolve_id_text(ids, reg, "v")) == [("A Society, C Society, C Society",)]
    assert rows(R.resolve_ids(ids.replace("1, sea;3", "coast"), reg, "v", "n"), "n") == [("C Society",)]


def test_the_whole_build_side_is_measured(spark):
    from indicatrix import load_registry
    from indicatrix.schemas import REGISTRY_SCHEMA
    wide = [("S", "C", "AAA", "A1", "long " * 100, "1", [f"alias {k}" for k in range(50)], [])]
    df = spark.createDataFrame(wide, REGISTRY_SCHEMA)
    assert not load_registry(df, max_bytes=20_000).broadcastable  # 56 names, each with the region's 500 bytes
    assert load_registry(df, max_bytes=40_000).broadcastable


def test_ids_of_a_user_are_never_forced_into_a_broadcast(spark):
    ids = spark.range(10).selectExpr("concat('X', id) entity_id", "concat('Name ', id) name")
    df = spark.createDataFrame([("X3",), ("afghanistan",), ("zz",)], "v string")
    out = R.resolve_ids(df, registry(spark), "v", "n", ids)
    assert rows(out, "n") == [("DAF001",), ("Name 3",), ("zz",)]
    text = L.resolve_id_text(spark.createDataFrame([("X3;X4",)], "v string"), registry(spark), "v", id_names=ids)
    assert rows(text) == [("Name 3, Name 4",)]
    for plan in (out, text):
        logical = plan._jdf.queryExecution().analyzed().toString()
        assert "strategy=broadcast" not in logical


def test_map_ids_both_ways(spark):
    pairs = spark.createDataFrame([("D1", "One"), ("D2", "Two")], "code string, name string")
    df = spark.createDataFrame([("D1",), ("D9",)], "x string")
    assert rows(R.map_ids(df, pairs, "x", "y", "code", "name")) == [("D1", "One"), ("D9", None)]
    back = spark.createDataFrame([("Two",)], "x string")
    assert rows(R.map_ids(back, pairs, "x", "y", "code", "name", reverse=True)) == [("Two", "D2")]


def test_cascade(spark, reg):
    values = ["DAF001", "albania", "Republic of  Albania", "zimbabwe rc", "daf001", "Mystery", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert rows(R.resolve_ids(df, reg, "v", "name"), "v", "name") == sorted([
        ("DAF001", "Afghan Red Crescent"), ("albania", "Albanian Red Cross"),
        ("Republic of  Albania", "Albanian Red Cross"), ("zimbabwe rc", "Zimbabwe Red Cross Society"),
        ("daf001", "daf001"), ("Mystery", "Mystery"), (None, None)], key=repr)
    names = spark.createDataFrame([("DAF001", "External name"), ("DAL001", "Albania ext")], "entity_id string, name string")
    got = dict(rows(R.resolve_ids(df, reg, "v", "name", names), "v", "name"))
    assert got["DAF001"] == "External name" and got["albania"] == "Albania ext" and got["zimbabwe rc"] == "DZW001"


def test_id_text(spark, reg):
    df = spark.createDataFrame([
        (1, "a", "DAF001; DAL001,,Zimbabwe , BAD, X9 ,OLD1"), (2, "b", "DAF001"), (3, "a", None), (4, "a", " ; ")],
        "id int, kind string, v string")
    out = L.resolve_id_text(df, reg, "v", F.col("kind") == "a", invalid=("BAD",), changed={"OLD1": "DZW001"})
    assert rows(out, "id", "v") == [
        (1, "Afghan Red Crescent, Albanian Red Cross, Zimbabwe Red Cross Society, X9, Zimbabwe Red Cross Society"),
        (2, "DAF001"), (3, None), (4, "")]


def test_lists(spark, reg):
    df = spark.createDataFrame([
        (1, ["kingdom of ruritania", "Albania", "Albania"]), (2, []), (3, None), (4, ["Utopia"])],
        "id int, country array<string>")
    out = L.resolve_list(df, reg, "country")
    assert rows(out, "id", "country") == [
        (1, ["Ruritania", "Albania", "Albania"]), (2, []), (3, None), (4, ["Utopia"])]
    rich = L.enrich_list(out, reg, "country")
    assert rows(rich, "id", "entity_name", "iso3") == [
        (1, ["Ruritanian Society", "Albanian Red Cross", "Albanian Red Cross"], ["RUR", "ALB", "ALB"]),
        (2, [], []), (3, None, None), (4, [None], ["UTO"])]
    unknown = spark.createDataFrame([(["Nowhere", "albania"],)], "country array<string>")
    assert rows(L.lookup_list(unknown, reg, "country", "iso3", "code"), "code") == [(["Nowhere", "ALB"],)]
    with pytest.raises(Exception, match="Nowhere"):
        L.resolve_list(unknown, reg, "country").collect()
