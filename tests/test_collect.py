import logging

import pytest
from pyspark.sql import functions as F

from indicatrix import dataset, datasets, indicators
from indicatrix.operators.latest import repeated_keys
from indicatrix.plans.catalogue import filter_catalogue, select_datasets
from indicatrix.plans import collect
from indicatrix.plans.collect import KINDS, Kind
from indicatrix.schemas import CATALOGUE_SCHEMA, UNIFIED_COLUMNS, with_titles

from fixtures import registry, rows

ENTRIES = [
    ("Risk", "risk_index", "API", None, "External", "public", None, None, None, False),
    ("Dates", "capacity_assessment_dates", "API", "d", "internal", "public", None, None, "Dates of assessments", False),
    ("Branches", "branch_assessment_dates", "API", "d", "Internal", "public", None, None, None, False),
    ("Presence", "field_presence", "website", None, "external", "public", "l", None, None, False),
    ("Laws", "recognition_laws", "file", None, "Internal", "confidential", None, "F P", None, False),
    ("Old", "human_development", "API", None, "External", "public", None, None, None, True),
]


@pytest.fixture()
def catalogue(spark):
    return spark.createDataFrame(ENTRIES, CATALOGUE_SCHEMA)


@pytest.fixture()
def raw(spark):
    dates = spark.createDataFrame([
        ("DAF001", "x", "A1", 2015, "d", "u1", "N"), ("DAF001", "x", "A2", 2012, "d", "u2", "S"),
        ("DAL001", "x", None, 2013, "d", "u3", "N")],
        "NsId string, NsName string, AssementCode string, YearOfAssesment int, SubmissionDate string, URL string, BranchName string")
    risk = spark.createDataFrame([
        ("AFG", "INFORM", "n", 7.5, 1, 1, "u", "", 2022), ("AFG", "INFORM", "n", 8.0, 1, 1, "u", "", 2023)],
        "Iso3 string, IndicatorId string, IndicatorName string, IndicatorScore double, nodelevel int, ValidityYear int, "
        "Unit string, Note string, Year int")
    presence = spark.createDataFrame([("Albania", True, "p", True, None)],
                                     "country string, presence boolean, url string, key_operation boolean, description string")
    laws = spark.createDataFrame([("Albania", "x")], "`National Society (NS)` string, `Law/other regulations in force` string")
    return {"Risk": risk, "Dates": dates, "Branches": dates, "Presence": presence, "Laws": laws}


def test_catalogue(spark, catalogue, caplog):
    assert rows(filter_catalogue(catalogue, {"Type": "EXTERNAL", "privacy": "public"}), "name") == [("Old",), ("Presence",), ("Risk",)]
    assert rows(filter_catalogue(catalogue, {"focal point": "f p"}), "name") == [("Laws",)]
    with pytest.raises(ValueError, match="colour"):
        filter_catalogue(catalogue, {"colour": "red"})
    names = lambda *a, **k: [e["name"] for e in select_datasets(catalogue, *a, **k)]
    assert names() == ["Risk", "Dates", "Branches", "Presence", "Laws"]
    with caplog.at_level(logging.WARNING):
        assert names([" rISK ", "nothing", "Old", "risk"]) == ["Risk"]
    assert "nothing not recognised" in caplog.text and "Old is archived" in caplog.text
    assert names(["Risk", "Laws"], {"privacy": "public"}) == ["Risk"]
    assert names(None, None, {"risk_index"}) == ["Risk"]
    short = spark.createDataFrame([("N", "k")], "name string, kind string")
    assert [e["name"] for e in select_datasets(short)] == ["N"]


def test_datasets(spark, catalogue, raw, caplog):
    reg = registry(spark)
    built = datasets(catalogue, raw, reg, filters={"privacy": "public"}, latest=True)
    assert list(built) == ["Risk", "Dates", "Branches", "Presence"]
    assert rows(built["Risk"], "value", "year") == [(8.0, 2023)]
    assert "latest does not apply to" in caplog.text
    del raw["Laws"]
    assert "Laws" not in datasets(catalogue, raw, reg)
    one = datasets(catalogue, raw, reg, country="Albania")
    assert {r["country"] for df in one.values() for r in df.collect()} == {"Albania"}
    with pytest.raises(ValueError, match="Nowhere"):
        datasets(catalogue, raw, reg, country="Nowhere")


def test_user_function_as_dataset(spark, raw):
    df = dataset(lambda raw, reg: raw.select(F.lit("Albania").alias("country")), raw["Laws"], registry(spark),
                 country=["Albania", "Zimbabwe"])
    assert rows(df) == [("Albania",)]


def test_indicators(spark, catalogue, raw, caplog):
    reg = registry(spark)
    df = indicators(catalogue, raw, reg, as_of="2024-01-01", ordered=True)
    assert df.columns == UNIFIED_COLUMNS
    assert with_titles(df).columns == ["National Society name", "Country", "ISO3", "Region", "Indicator", "Value", "Year",
                                       "Description", "URL", "Dataset"]
    got = [(r["dataset"], r["indicator"], r["value"], r["year"], r["description"], r["url"]) for r in df.collect()]
    assert got == [
        ("Branches", "Number of branch assessments", "2", None, "", ""),
        ("Branches", "Number of branch assessments", "0", None, "", ""),
        ("Dates", "Dates of assessments", "2012", None, "", "u2"), ("Dates", "Dates of assessments", "2015", None, "", "u1"),
        ("Dates", "Dates of assessments", "2013", None, "", "u3"),
        ("Presence", "Field presence", "True", 2024, None, "p"),
        ("Risk", "INFORM Risk Index", "7.5", 2022, "", ""), ("Risk", "INFORM Risk Index", "8.0", 2023, "", "")]
    latest = indicators(catalogue, raw, reg, latest=True, as_of="2024-01-01")
    assert repeated_keys(latest).count() == 0
    # Without years the smallest value wins: the earliest assessment.
    assert ("Dates", "2012") in rows(latest, "dataset", "value") and ("Dates", "2015") not in rows(latest, "dataset", "value")
    assert ("Risk", "8.0") in rows(latest, "dataset", "value")


def test_value_split_is_a_partition(spark, catalogue, raw):
    reg = registry(spark)
    every = indicators(catalogue, raw, reg, as_of="2024-01-01")
    numbers = indicators(catalogue, raw, reg, quantitative=True, as_of="2024-01-01")
    others = indicators(catalogue, raw, reg, quantitative=False, as_of="2024-01-01")
    assert numbers.schema["value"].dataType.simpleString() == "double"
    assert others.schema["value"].dataType.simpleString() == "string"
    assert numbers.count() + others.count() == every.count() == 8
    assert rows(numbers, "value") == [(0.0,), (2.0,), (2012.0,), (2013.0,), (2015.0,)]
    assert rows(indicators(catalogue, raw, reg, names=["risk"], quantitative=True, numeric="any"), "value") == [(7.5,), (8.0,)]


def test_selection_in_indicator_form(spark, catalogue, raw, caplog):
    reg = registry(spark)
    df = indicators(catalogue, raw, reg, names=["Laws", "risk"])
    assert rows(df.select("dataset").distinct()) == [("Risk",)]
    assert "Dropping dataset Laws" in caplog.text
    empty = indicators(catalogue, raw, reg, names=["Laws"])
    assert empty.columns == UNIFIED_COLUMNS and empty.count() == 0


def test_one_dataset_of_the_union_is_read_alone(spark, catalogue, raw):
    df = indicators(catalogue, raw, registry(spark), as_of="2024-01-01").where("dataset = 'Risk'")
    assert "Union" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_wrong_columns_are_named(spark, catalogue, raw):
    kinds = {**KINDS, "risk_index": Kind(lambda raw, reg: raw, False, lambda df, entry, as_of: df)}
    with pytest.raises(ValueError, match="Columns of Risk do not match. Extra columns"):
        indicators(catalogue, raw, registry(spark), names=["Risk"], kinds=kinds)


@pytest.mark.parametrize("kind, ddl, row, key", [
    ("documents", "entity_id string, name string, document_type string, year int, url string", ("DAL001", "n", "Our Emblem Law", 2020, "u"), "entity_id"),
    ("contacts", "NSO_DON_name string, country string, iso_3 string, NSO_ZON_name string, cur_code string, url string, facebook string, "
                 "twitter string, othersocial string", ("Albanian Red Cross", "Albania", "ALB", "Europe", "ALL", "u", "f", "t", "o"), "iso_3"),
    ("operations", "name string, atype_display string, status_display string, num_beneficiaries int, amount_requested string, "
                   "amount_funded string, start_date string, end_date string, dtype struct<name: string>, region struct<id: int>, "
                   "country struct<name: string, society_name: string, iso3: string>",
     ("o", "a", "Active", 1, "2", "1", None, None, ("flood",), (1,), ("Albania", "Albanian Red Cross", "ALB")), "country.iso3")])
def test_entity_filters_reach_the_scan(spark, tmp_path, kind, ddl, row, key):
    path = str(tmp_path / kind)
    spark.createDataFrame([row], ddl).write.parquet(path)
    out = collect.dataset(kind, spark.read.parquet(path), registry(spark), country=["Albania"])
    scan = out._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in scan.split("\n") if "PushedFilters" in line]
    assert any(f"EqualTo({key}," in line or f"In({key}," in line for line in pushed), pushed
    assert out.count() > 0
    assert collect.dataset(kind, spark.read.parquet(path), registry(spark), country=["Afghanistan"]).count() == 0


def test_unknown_entities_of_a_dataset(spark):
    raw = spark.createDataFrame([("ALB",), ("QQQ",), ("QQQ",), (None,)], "iso3 string")
    assert rows(collect.unknown_entities("corruption_perception", raw, registry(spark))) == [("QQQ", 2)]
    with pytest.raises(ValueError):
        collect.unknown_entities("evaluations", raw, registry(spark))
