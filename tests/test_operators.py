import pytest
from pyspark.sql import functions as F

from indicatrix.functions import text as TX, values as V
from indicatrix.operators import checks as C, columns as K, filters as X, latest as T, reshape as S

from fixtures import registry, rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# ---------------------------------------------------------------- text and values

def test_text_functions(spark):
    assert one(spark, TX.normalise(F.lit("  a \t\n b "))) == "a b"
    assert one(spark, TX.strip(F.lit("  a  b\n"))) == "a  b"
    assert one(spark, TX.match_key(F.lit(" A  B "))) == "a b"
    assert one(spark, TX.split_list(F.lit("a; b ,, ;c"))) == ["a", "b", "c"]
    assert one(spark, TX.join_list(F.array(F.lit("a"), F.lit("b")))) == "a, b"
    listed = F.array(F.lit(" x "), F.lit("Global"), F.lit(None).cast("string"), F.lit("-"))
    assert one(spark, TX.clean_list(listed, ["global", "-"])) == ["x"]
    assert one(spark, TX.recode_list(F.array(F.lit("a"), F.lit("b")), {"a": "b", "b": "c"})) == ["b", "c"]
    assert one(spark, TX.replace_in_order(F.lit("a, b and c"), {"a, b": "c", "c and c": "done"})) == "done"
    assert TX.header_name("﻿1.\nSociety (S) ", numbered=True) == "Society (S)"
    assert TX.header_name(" Plain ") == "Plain"


@pytest.mark.parametrize("text,digits,number", [
    ("7", True, True), ("7.0", False, True), ("-1", False, True), ("", False, False), (None, False, False),
    ("½", False, False), ("12\n", False, True), ("abc", False, False), ("٣", False, False)])
def test_quantitative(spark, text, digits, number):
    c = F.lit(text).cast("string")
    assert one(spark, V.is_quantitative(c)) is digits
    assert one(spark, V.is_quantitative(c, "any")) is number


def test_values(spark):
    assert one(spark, V.rounded_percentage(F.lit(1), F.lit(2))) == 0.0
    assert one(spark, V.rounded_percentage(F.lit(3), F.lit(2))) == 200.0
    assert one(spark, V.rounded_percentage(F.lit(1), F.lit(0))) is None
    df = spark.createDataFrame([("a",), (None,), ("b",)], "c string")
    assert rows(df.where(V.differs(F.col("c"), "a"))) == [("b",), (None,)]
    assert rows(df.where(V.not_in(F.col("c"), ["a"]))) == [("b",), (None,)]
    assert one(spark, V.yes_no(F.lit("True"), F.lit(True))) == "Yes"
    assert one(spark, V.yes_no(F.lit("False"), F.lit(False))) == "False"
    assert one(spark, V.timestamp_or_null(F.lit("0001-01-01T00:00:00Z"), "0001-01-01T00:00:00Z")) is None
    assert str(one(spark, V.timestamp_or_null(F.lit("2020-02-03T04:05:06Z")))) == "2020-02-03 04:05:06"
    assert one(spark, V.strict_number(F.lit("2011.0"))) == 2011
    assert one(spark, V.year_of("2022-01-01")) == 2022
    with pytest.raises(Exception):
        one(spark, V.strict_number(F.lit("20x1")))


# ---------------------------------------------------------------- columns

def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, `b.c` int, d int")
    assert K.rename_strict(df, {"a": "z"}).columns == ["z", "b.c", "d"]
    assert K.rename(df, {"nope": "z"}).columns == df.columns
    assert K.index_first(df, ["d"], index=["b.c"]).columns == ["b.c", "d", "a"]
    assert K.index_first(df, ["d"], True, index=["b.c"]).columns == ["b.c", "d"]
    assert K.index_first(df, index=["d"]).columns == ["d", "a", "b.c"]
    assert K.drop_existing(df, ["b.c", "zz"]).columns == ["a", "d"]
    assert rows(K.add_missing(df, ["a", "url"]), "a", "url") == [(1, "")]
    assert K.conform(df, ["d", "a", "b.c"], "t").columns == ["d", "a", "b.c"]
    for bad in (lambda: K.rename_strict(df, {"nope": "z"}), lambda: K.drop_strict(df, ["nope"]),
                lambda: K.index_first(df, index=["nope"])):
        with pytest.raises(ValueError, match="nope"):
            bad()
    with pytest.raises(ValueError, match=r"Extra columns: \['d'\]. Missing columns: \['q'\]"):
        K.conform(df, ["a", "b.c", "q"], "t")


# ---------------------------------------------------------------- latest

def test_latest_indicators_order_nulls_and_ties(spark):
    df = spark.createDataFrame([
        ("E", "i", 2020, "9", "b"), ("E", "i", 2020, "10", "a"), ("E", "i", 2019, "1", "a"),
        ("E", "j", None, "text", "x"), ("E", "j", None, "20", "x"),
        (None, "i", 2000, "1", "x"), (None, "i", 2001, "5", "x"),
        ("E", "k", 2020, "same", "b"), ("E", "k", 2020, "same", "a"), ("E", "l", 2020, None, "n")],
        "entity_name string, indicator string, year int, value string, url string")
    out = T.latest_indicators(df)
    assert rows(out) == sorted([
        ("E", "i", 2020, "9", "b"), ("E", "j", None, "20", "x"), (None, "i", 2001, "5", "x"),
        ("E", "k", 2020, "same", "a"), ("E", "l", 2020, None, "n")], key=repr)
    assert rows(T.latest_indicators(out)) == rows(out)
    assert T.repeated_keys(out, ("entity_name", "indicator")).count() == 0


def test_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as entity_name", "'i' as indicator", "1 as year", "id as value")
    plan = T.latest_indicators(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_latest_with_one_hot_key_matches_brute_force(spark):
    df = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('e', id % 997)) as entity_name", "'i' as indicator",
        "cast(2000 + (id * 7919) % 20 as int) as year", "(id * 104729) % 1000 as value", "id").repartition(4, "id")
    best = {}
    for r in df.collect():
        rank = (-r["year"], r["value"], r["id"])
        best[r["entity_name"]] = min(best.get(r["entity_name"], rank), rank)
    got = {r["entity_name"]: (-r["year"], r["value"], r["id"]) for r in T.latest_indicators(df).collect()}
    assert got == best


def test_latest_per_entity_and_derived_years(spark):
    df = spark.createDataFrame([
        ("A", "ar", "Yes", 2018), ("A", "ar", "Yes", 2020), ("A", "ar", "No", 2021), ("A", "other", "Yes", 2022),
        (None, "ar", "Yes", 2011)], "entity_name string, indicator string, value string, year int")
    assert rows(T.latest_per_entity(df), "entity_name", "year") == [("A", 2022), (None, 2011)]
    added = T.latest_year_rows(df, {"ar": "Year of latest annual report"})
    assert rows(added) == [("A", "Year of latest annual report", "2020", 2020),
                           (None, "Year of latest annual report", "2011", 2011)]
    assert T.with_latest_years(df, {"ar": "L"}).count() == 7


# ---------------------------------------------------------------- reshape

def test_melt_and_transpose(spark):
    df = spark.createDataFrame([("a", 1, None, "x"), ("b", 2, 2.5, None)], "k string, n int, d double, s string")
    assert rows(S.melt(df, ["k"], ["n", "s"])) == sorted([
        ("a", "n", "1"), ("a", "s", "x"), ("b", "n", "2"), ("b", "s", None)], key=repr)
    turned = S.transpose(df, "k", ["n", "s"])
    assert rows(turned, "column", "a", "b") == [("n", "1", "2"), ("s", "x", None)]
    assert S.transpose(df, "k", ["n"], rows=["b"]).columns == ["column", "b"]


def test_expand_dicts(spark):
    df = spark.createDataFrame([
        (1, "{'a': None, 'b': {'c': True, 'd': \"it's None, really\"}}"), (2, None)], "id int, t string")
    out = S.expand_dict_columns(df, {"t": "a STRING, b STRUCT<c: BOOLEAN, d: STRING>"}, True, "python")
    assert out.columns == ["id", "t.a", "t.b.c", "t.b.d"]
    assert rows(out)[0] == (1, None, True, "it's None, really") and rows(out)[1] == (2, None, None, None)
    broken = spark.createDataFrame([("{oops",), ('{"a": "1"}',)], "t string")
    assert rows(S.parse_dict(broken, "t", "a STRING", errors="null").select("t.a")) == [("1",), (None,)]
    with pytest.raises(Exception):
        S.parse_dict(broken, "t", "a STRING").select("t.a").collect()
    kept = S.expand_struct(S.parse_dict(broken.where("t like '%1%'"), "t", "a STRING"), "t", drop=[False], sep="_")
    assert kept.columns == ["t", "t_a"]


def test_to_indicator(spark):
    df = spark.createDataFrame([("A", 5, "x")], "entity_name string, n int, junk string")
    out = S.to_indicator(df, "n", "Count", 2020, drop=("junk",), url="u")
    assert out.first().asDict() == {"entity_name": "A", "value": "5", "indicator": "Count", "year": 2020, "url": "u"}
    assert S.to_indicator(df, "n", "Count", None).first()["year"] is None


# ---------------------------------------------------------------- checks and filters

def test_null_handling(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, None), (2, "a", None)], "a int, b string, c string")
    assert C.drop_null_keys(df, ["a", "b"]).count() == 1
    assert C.drop_empty_rows(df).count() == 2
    assert C.drop_empty_columns(df).columns == ["a", "b"]
    assert rows(C.count_per_entity(df, ["a"], "b", "n")) == [(1, 0), (2, 1)]


def test_invariants(spark):
    df = spark.createDataFrame([("x", "public"), ("x", "public")], "y string, v string")
    assert C.require_single_value(df, "y").count() == 2
    assert C.require_equal(df, "v", "public", "no").count() == 2
    mixed = df.unionByName(spark.createDataFrame([(None, None)], "y string, v string"))
    with pytest.raises(Exception, match="Unexpected values in y"):
        C.require_single_value(mixed, "y").collect()
    with pytest.raises(Exception, match="not all public"):
        C.require_equal(mixed, "v", "public", "not all public").collect()
    assert C.require_single_value(df.limit(0), "y").count() == 0


def test_recode(spark):
    df = spark.createDataFrame([("a",), ("b",), ("B!",), ("c",), (None,)], "i string")
    labels = {"a": "A!", "b": "B!"}
    assert rows(C.recode(df, "i", labels)) == [("A!",), ("B!",), ("B!",)]
    assert C.recode(df, "i", labels, allow_only=False).count() == 5
    table = spark.createDataFrame(list(labels.items()), "code string, label string")
    assert rows(C.recode_from(df, "i", table)) == [("A!",), ("B!",), ("B!",)]


def test_entity_filters(spark):
    reg = registry(spark)
    df = spark.createDataFrame([("AFG", "Afghanistan"), ("ALB", "Albania"), (None, None)], "iso3 string, country string")
    assert rows(X.filter_entities(df, reg, iso3="AFG"), "iso3") == [("AFG",)]
    assert X.filter_entities(df, reg, iso3=["AFG", "ALB"], country="Albania").count() == 1
    with pytest.raises(ValueError, match="Atlantis"):
        X.filter_entities(df, reg, country=["Albania", "Atlantis"])
    with pytest.raises(TypeError):
        X.filter_entities(df, reg, country=5)
    arrays = spark.createDataFrame([(["Albania", None],), ([None],), (None,), ([],)], "country array<string>")
    assert X.filter_entities(arrays, reg, country="Albania").count() == 1
    many = [f"v{i}" for i in range(1500)] + ["Albania"]
    assert X.keep_values(df, "country", many).count() == 1
    assert X.keep_values(df, "country", []).count() == 0


def test_source_keys_reach_the_scan(spark, tmp_path):
    reg = registry(spark)
    path = str(tmp_path / "raw")
    spark.createDataFrame([("DAF001", 1), ("DAL001", 2)], "code string, v int").write.parquet(path)
    raw = spark.read.parquet(path)
    kept = X.restrict_to_keys(raw, "code", reg, {"region": ["Europe"]})
    assert rows(kept) == [("DAL001", 2)]
    assert "PushedFilters: [IsNotNull(code), EqualTo(code,DAL001)]" in kept._jdf.queryExecution().toString()
    large = registry(spark, max_rows=2)
    assert rows(X.restrict_to_keys(raw, "code", large, {"region": ["Europe"]})) == [("DAL001", 2)]


def test_dictionary_text_keeps_what_strings_hold(spark):
    cells = [{"name": "a, None, b", "x": None, "y": True, "n": 1}, {"name": "Yes, True, x", "x": "None", "y": False, "n": 2},
             {"name": "a\xa0b\x07", "x": "it's", "y": None, "n": 3}, {"name": "q\"uo'te\\", "x": "\\xa0 raw", "y": True, "n": None},
             {"name": "[None]", "x": "{True: False}", "y": False, "n": 4}, {"name": "x, None " * 3000, "x": "é☃", "y": True, "n": 5},
             {"name": "line\nbreak\ttab", "x": "Nonesuch", "y": True, "n": 6}]
    df = spark.createDataFrame([(k, str(c)) for k, c in enumerate(cells)], "id int, d string")
    out = S.parse_dict(df, "d", "name string, x string, y boolean, n int", "python").orderBy("id").collect()
    assert [r.d.asDict() for r in out] == cells


def test_numbers_become_text_without_an_exponent(spark):
    from indicatrix.functions.values import as_text
    df = spark.createDataFrame([(38041754.0,), (19291104008.0,), (0.5,), (1e-5,), (-12345678.9,), (1e300,), (None,), (3.0,)], "v double")
    got = [r[0] for r in df.select(as_text(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == ["38041754.0", "19291104008.0", "0.5", "0.00001", "-12345678.9", "1.0E300", None, "3.0"]


def test_transpose_as_rows(spark):
    df = spark.createDataFrame([("a", "1", "2"), ("b", None, "3"), (None, "x", "y"), ("a", "9", "9")], "l string, p string, q string")
    assert rows(S.transpose_long(df, "l", column_name="c")) == [
        ("p", "a", "1"), ("p", "b", None), ("q", "a", "2"), ("q", "b", "3")]
