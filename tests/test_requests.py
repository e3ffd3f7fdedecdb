"""Keys nobody names beforehand, results as maps, whole sets of pages, counted warnings, and snapshots that failed runs keep."""

import pytest
from pyspark.sql import functions as F

from indicatrix.operators import reshape as S
from indicatrix.operators.registry import UnknownRows
from indicatrix.plans.collect import dataset, datasets
from indicatrix.schemas import CATALOGUE_SCHEMA
from indicatrix.sources import payloads as P, snapshots as N

from fixtures import registry, rows


def test_keys_are_found_whatever_rows_hold(spark):
    texts = ["{'a': 1, 'b c': 'it\\'s', 'n': {'k': None, 'z': [1, 2]}}", "{'a': 't', 'd': 1.5, 'n': {'k': True, 'VARIANT': 2}}", None, "{}",
             "{'void': None, 'e': {}}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, c string")
    assert S.discover_dicts(df, ["c"], "python")["c"].simpleString() == (
        "struct<a:string,b c:string,d:double,e:string,n:struct<VARIANT:bigint,k:boolean,z:array<bigint>>,void:string>")
    out = S.expand_dict_columns(df, {"c": None}, drop=True, text="python")
    assert out.columns == ["id", "c.a", "c.b c", "c.d", "c.e", "c.n.VARIANT", "c.n.k", "c.n.z", "c.void"]
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert got[0] == ("1", "it's", None, None, None, None, [1, 2], None)
    assert got[1] == ("t", None, 1.5, None, 2, True, None, None)
    assert got[2] == got[3] == (None,) * 8 and got[4] == (None, None, None, "{}", None, None, None, None)
    empty = spark.createDataFrame([(1, None), (2, "{}")], "id int, c string")
    assert S.expand_dict_columns(empty, {"c": None}, drop=True).columns == ["id"]
    with pytest.raises(ValueError, match="other values"):
        S.discover_dicts(spark.createDataFrame([("[1]",)], "c string"), ["c"])


def test_transposed_cells_as_maps(spark):
    df = spark.createDataFrame([("x", "1", None), ("y", "2", "3"), ("x", "4", "5"), (None, "6", "7")], "label string, a string, b string")
    out = {r["column"]: r["cells"] for r in S.transpose_map(df, "label").collect()}
    assert out["a"].keys() == {"x", "y"} and out["a"]["y"] == "2" and out["a"]["x"] in ("1", "4")
    assert out["b"] == {"x": "5", "y": "3"}


def test_assessments_need_no_labels(spark):
    sheet = [("Code", "iso", "AFG", "ALB", None), (None, "National Society", "Zimbabwe RC", "Albanian Red Cross", "Zimbabwe RC"),
             (None, "Year", "2015", "2016", "2018.0"), ("X1", None, "3", None, "5"), ("X4", "Result", "yes", "no", None)]
    raw = spark.createDataFrame(sheet, "Code string, Name string, c1 string, c2 string, c3 string")
    jobs, known = spark.sparkContext.statusTracker(), registry(spark)
    spark.sparkContext.setJobGroup("building", "building")
    df = dataset("capacity_assessments", raw, known)
    assert not jobs.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert df.columns == ["entity_name", "country", "iso3", "region", "year", "results"]
    assert rows(df.select("entity_name", "year", F.array_sort(F.transform(
        F.map_entries("results"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))))) == sorted([
        ("Zimbabwe Red Cross Society", 2015, ["Result=yes", "X1=3"]), ("Albanian Red Cross", 2016, ["Result=no"]), ("Zimbabwe Red Cross Society", 2018, ["X1=5"])], key=repr)
    newest = dataset("capacity_assessments", raw, registry(spark), latest=True)
    assert rows(newest, "entity_name", "year") == [("Albanian Red Cross", 2016), ("Zimbabwe Red Cross Society", 2018)]


def pages(spark, numbers, total=3):
    return spark.createDataFrame([(f'[{{"page": {n}, "pages": {total}, "total": "9"}}, [{{"v": {n}}}]]',) for n in numbers], "value string")


def test_all_announced_pages_must_be_there(spark):
    assert rows(P.page_element_rows(pages(spark, [2, 3, 1]), "value", "v INT", metadata=0)) == [(1,), (2,), (3,)]
    for wrong in ([1, 3], [1, 2, 2], [1, 2, 3, 3], [2, 3, 4], [0, 1, 2, 3]):
        with pytest.raises(Exception, match="missing or doubled"):
            P.page_element_rows(pages(spark, wrong), "value", "v INT", metadata=0).collect()
    other = pages(spark, [1, 2]).unionByName(pages(spark, [3], total=4))
    with pytest.raises(Exception, match="missing or doubled"):
        P.page_element_rows(other, "value", "v INT", metadata=0).collect()
    assert P.page_element_rows(pages(spark, []), "value", "v INT", metadata=0).collect() == []
    assert P.page_ledger(pages(spark, [1, 1]), "value").first().asDict() == {
        "announced": 3, "least": 3, "landed": 2, "different": 1, "first": 1, "last": 1}


def test_unknown_values_are_counted_on_request(spark):
    raw = spark.createDataFrame([("Albania", "t"), ("Nowhere", "u"), ("Nowhere", "v"), (None, "w"), ("  republic  of albania ", "x")],
                                "Country string, Type string").withColumn("Region", F.lit("r"))
    with pytest.raises(Exception, match="Unknown country value"):
        dataset("logistics_projects", raw, registry(spark)).collect()
    unknown = UnknownRows()
    df = dataset("logistics_projects", raw, registry(spark), errors="warn", unknown=unknown)
    got = rows(df, "country", "Type")
    assert len(got) == 5 and ("Nowhere", "u") in got
    assert unknown.counts() == [{"column": "country", "unknown_rows": 2, "null_rows": 1}]
    assert len(dataset("logistics_projects", raw, registry(spark), errors="ignore").collect()) == 5
    with pytest.raises(ValueError, match="UnknownRows"):
        dataset("logistics_projects", raw, registry(spark), errors="warn")
    entry = {f.name: None for f in CATALOGUE_SCHEMA}
    catalogue = spark.createDataFrame([tuple({**entry, "name": n, "kind": k, "archived": False}.values())
                                       for n, k in (("L", "logistics_projects"), ("E", "evaluations"))], CATALOGUE_SCHEMA)
    lists = spark.createDataFrame([("Albania, Nowhere, Elsewhere", "t"), ("Elsewhere", "u"), (None, "v")], "country string, title string")
    warnings = {}
    built = datasets(catalogue, {"L": raw, "E": lists}, registry(spark), warnings=warnings)
    for table in built.values():
        table.collect()
    assert warnings["L"].counts()[0]["unknown_rows"] == 2
    assert warnings["E"].counts() == [{"column": "country", "unknown_rows": 3, "null_rows": 0}]


def test_a_failed_write_keeps_the_last_version(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(Exception):
        N.read_snapshot(spark, root, "raw")
    first = spark.createDataFrame([(1, ("x", [1, 2]), "")], "id int, s struct<a: string, b: array<int>>, t string")
    N.write_snapshot(first, root, "raw")
    broken = first.withColumn("id", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        N.write_snapshot(broken, root, "raw")
    assert rows(N.read_snapshot(spark, root, "raw")) == rows(first)
    N.write_snapshot(first.withColumn("id", F.lit(2)), root, "raw", partition_by=["id"])
    assert N.read_snapshot(spark, root, "raw").first()["id"] == 2
    oldest = N.versions(spark, root, "raw").orderBy("version").first()["version"]
    assert N.versions(spark, root, "raw").count() == 2 and N.read_snapshot(spark, root, "raw", oldest).first()["id"] == 1
    with pytest.raises(ValueError, match="No whole version"):
        N.read_snapshot(spark, root, "raw", "none")


def test_text_snapshots_read_back(spark, tmp_path):
    data = [(1, 'a "b"\nc,', ("x", [1, 2])), (2, "", None), (3, None, (None, []))]
    df = spark.createDataFrame(data, "id int, t string, s struct<a: string, b: array<int>>")
    N.write_snapshot(df, str(tmp_path), "raw", text=True)
    back = N.read_snapshot(spark, str(tmp_path), "raw")
    assert rows(back, "id", "t") == rows(df, "id", "t")
    assert rows(S.expand_dict_columns(back, {"s": None}), "id", "`s.a`") == [(1, "x"), (2, None), (3, None)]


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 2, "max_map_keys": 1}])
def test_keys_in_text_spare_the_rest_of_the_rows(spark, bounds):
    """Rows of other countries name what the registry does not know: they are dropped by their key before they are looked up."""
    def operation(i, country):
        return (f"op {i}", "a", "Active", 1, "100.0", "50.0", "2020-01-01T00:00:00Z", "2020-01-01T00:00:00Z", '{"name": "flood"}', "{}", country)
    texts = ['{"iso3": "AFG", "society_name": "Afghan Red Crescent"}', '{"iso3": "ALB", "society_name": "Nobody"}', '{"iso3": "ALB", "society_name": "Nobody"}',
             '{"society_name": "Afghan Red Crescent"}', '{"society_name": "Zimbabwe RC"}', None]
    names = ("name atype_display status_display num_beneficiaries amount_requested amount_funded start_date end_date dtype region "
             "country").split()
    raw = spark.createDataFrame([operation(i, t) for i, t in enumerate(texts)],
                                ", ".join(f"{n} {'int' if n == 'num_beneficiaries' else 'string'}" for n in names))
    known = registry(spark, **bounds)
    assert rows(dataset("operations", raw, known, iso3=["AFG"]), "operation_name", "iso3") == [("op 0", "AFG"), ("op 3", "AFG")]
    with pytest.raises(Exception):
        dataset("operations", raw, known).collect()
