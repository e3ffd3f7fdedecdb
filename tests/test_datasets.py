"""Every dataset end to end on small inputs of the source's shape."""

import pytest
from pyspark.sql import functions as F

from indicatrix.plans import datasets as D
from indicatrix.schemas import INDEX_COLUMNS, with_titles
from indicatrix.sources import delimited as DL, payloads as P

from fixtures import registry, rows

AFG = ("Afghan Red Crescent", "Afghanistan", "AFG", "Asia Pacific")
ALB = ("Albanian Red Cross", "Albania", "ALB", "Europe")
ZWE = ("Zimbabwe Red Cross Society", "Zimbabwe", "ZWE", "Africa")


@pytest.fixture()
def reg(spark):
    return registry(spark)


def sheet(tmp_path, text):
    path = tmp_path / "sheet.csv"
    path.write_text(text, encoding="utf-8-sig", newline="")
    return str(path)


def index_first(df):
    assert df.columns[:4] == INDEX_COLUMNS
    return df


def test_databank(spark, reg):
    raw = spark.createDataFrame([
        ("ar", "DAF001", 2019, "True"), ("ar", "DAF001", 2020, "true"), ("ar", "DAF001", 2021, "False"),
        ("supported1", "DAL001", 2020, "DZW001; Afghanistan,DBE004, DCS001,Somewhere"),
        ("received_support1", "DAL001", 2020, "One of our staff was sent for support to DRC-Congo on a surge"),
        ("KPI_noLocalUnits", "DZW001", 2020, "True"), ("KPI_noLocalUnits", "D?", 2020, "3"),
        ("unlisted", "DAF001", 2020, "1"), ("ar", "DAF001", None, "True"), (None, "DAF001", 2020, "True"),
        ("sp", "DAF001", 2020, None)], "indicator string, entity_id string, year int, value string")
    df = index_first(D.databank(raw, reg, page_prefix="p/", invalid_ids=["DBE004"]))
    assert df.columns[4:] == ["indicator", "value", "year", "url"]
    assert rows(df) == sorted([
        AFG + ("Annual report available", "Yes", 2019, "p/DAF001"), AFG + ("Annual report available", "Yes", 2020, "p/DAF001"),
        AFG + ("Annual report available", "No", 2021, "p/DAF001"),
        AFG + ("Year of latest annual report", "2020", 2020, "p/DAF001"),
        ALB + ("Supported NSs", "Zimbabwe Red Cross Society, Afghan Red Crescent, DRS001, Somewhere", 2020, "p/DAL001"),
        ALB + ("Received support from NSs", "Red Cross of the Democratic Republic of the Congo", 2020, "p/DAL001"),
        ZWE + ("Number of local units", "True", 2020, "p/DZW001"),
        (None, None, None, None, "Number of local units", "3", 2020, "p/D?")], key=repr)
    latest = rows(D.databank(raw, reg, latest=True, invalid_ids=[]), "indicator", "value", "year")
    assert ("Annual report available", "No", 2021) in latest and ("Annual report available", "Yes", 2020) not in latest


def test_documents(spark, reg):
    raw = spark.createDataFrame([
        ("DAF001", "n", " Our Annual Report ", 2020, "b"), ("DAF001", "n", "Our Annual Report", 2020, "a"),
        ("DAF001", "n", "Our Emblem Law", None, "x"), ("DAL001", "n", "Strategic Plan", 2019, "s"),
        ("DAL001", "n", "Other", 2019, "o")],
        "entity_id string, name string, document_type string, year int, url string")
    assert rows(D.documents(raw, reg)) == sorted([
        AFG + ("Annual report", "a", 2020), AFG + ("Annual report", "b", 2020), ALB + ("Strategic Plan", "s", 2019)])
    assert rows(D.documents(raw, reg, latest=True)) == sorted([
        AFG + ("Annual report", "a", 2020), ALB + ("Strategic Plan", "s", 2019)])
    unknown = spark.createDataFrame([("D?", "n", "Our Emblem Law", 2020, "x")], raw.schema)
    with pytest.raises(Exception, match="Unknown entity_id value in data: D?"):
        D.documents(unknown, reg).count()


def test_contacts(spark, reg):
    raw = spark.createDataFrame([("afghan red crescent society", "Own", "OWN", "Zone", "AFN", "w", None, "t", "o")],
                                "NSO_DON_name string, country string, iso_3 string, NSO_ZON_name string, cur_code string, "
                                "url string, facebook string, twitter string, othersocial string")
    own = ("Afghan Red Crescent", "Own", "OWN", "Zone")
    assert rows(D.contacts(raw, reg)) == sorted([
        own + ("Currency", "AFN", None), own + ("URL", "w", None), own + ("Facebook", None, None),
        own + ("Twitter", "t", None), own + ("Other social", "o", None)], key=repr)
    with pytest.raises(ValueError, match="iso_3"):
        D.contacts(raw.drop("iso_3"), reg)


SHEET = """Code,Name,C1,C1,C2
,iso,AF,AF,AL
,National Society,Afghan Red Crescent,afghan  red crescent society,Albanian Red Cross
,Region,r,r,s
,SubRegion,,,
,Year,2011,2014.0,2016
,Month,,,
X1,Workshop,,,
X2,OCAC data public,False,False,False
X3, Strength ,High,,Low
X4,,1,2,3
"""


def test_capacity_assessments(spark, reg, tmp_path):
    raw = DL.read_table(spark, sheet(tmp_path, SHEET))
    df = index_first(D.capacity_assessments(raw, reg))
    assert sorted(df.columns[5:]) == ["Strength", "X4"]
    assert rows(df, *INDEX_COLUMNS, "year", "Strength", "X4") == sorted([
        AFG + (2011, "High", "1"), AFG + (2014, None, "2"), ALB + (2016, "Low", "3")], key=repr)
    assert rows(D.capacity_assessments(raw, reg, latest=True, indicators=["X4"]), "entity_name", "year", "X4") == [
        ("Afghan Red Crescent", 2014, "2"), ("Albanian Red Cross", 2016, "3")]


def test_assessment_dates(spark, reg):
    raw = spark.createDataFrame([("daf001", "x", "A1", 2015, "2015-05-05", "u", "North")],
                                "NsId string, NsName string, AssementCode string, YearOfAssesment int, "
                                "SubmissionDate string, URL string, BranchName string")
    assert rows(D.capacity_assessment_dates(raw, reg)) == [AFG + ("A1", 2015, "2015-05-05", "u")]
    df = D.branch_assessment_dates(raw, reg)
    assert rows(df) == [AFG + ("North", "A1", 2015, "2015-05-05", "u")]
    assert with_titles(df).columns == ["National Society name", "Country", "ISO3", "Region", "Branch name",
                                       "Assessment code", "Year of assessment", "Submission date", "URL"]


OPERATION = ("name string, atype_display string, status_display string, num_beneficiaries int, amount_requested string, "
             "amount_funded string, start_date string, end_date string, dtype struct<name: string>, "
             "region struct<id: int>, country struct<name: string, society_name: string>")


def test_operations(spark, reg):
    def row(name, status, asked, funded, society):
        return (name, "Appeal", status, 5, asked, funded, "2020-01-02T03:04:05Z", D.NO_DATE, ("Flood",), (1,), ("c", society))
    raw = spark.createDataFrame([
        row("half", "Active", "200", "100", "Zimbabwe RC"), row("most", "Active", "100.0", "75", "Zimbabwe RC"),
        row("none", "Active", "0", "75", "Albanian Red Cross"), row("old", "Closed", "1", "1", "Zimbabwe RC"),
        row("blank", "Active", "1", "1", ""), row("null", "Active", "1", "1", None)], OPERATION)
    assert rows(D.operations(raw, reg)) == sorted([
        ZWE + ("half", "Appeal", 5, 200.0, 100.0, "Flood", 0.0), ZWE + ("most", "Appeal", 5, 100.0, 75.0, "Flood", 100.0),
        ALB + ("none", "Appeal", 5, 0.0, 75.0, "Flood", None)])
    text = raw.withColumns({c: F.to_json(c, {"ignoreNullFields": "false"}) for c in ("dtype", "region", "country")})
    assert rows(D.operations(text, reg)) == rows(D.operations(raw, reg))


def test_projects(spark, reg):
    schema = ("name string, primary_sector_display string, programme_type_display string, operation_type_display string, "
              "visibility string, start_date string, end_date string, budget_amount int, actual_expenditure int, "
              "target_total int, reached_total int, project_country_detail string, dtype_detail string, "
              "event_detail string, reporting_ns_detail string")
    row = ("P", "Health", "Bilateral", "Programme", "public", "2020-01-02", None, 1, 2, 3, 4,
           "{'society_name': 'Albanian Red Cross', 'id': 2}", "{'name': 'Flood'}", None, "{'society_name': 'x'}")
    raw = spark.createDataFrame([row, row[:11] + ("{'society_name': None}",) + row[12:]], schema)
    [got] = D.projects(raw, reg, text="python").collect()
    assert tuple(got)[:8] == ALB + ("P", "Flood", None, "Health")
    assert str(got["start_date"]) == "2020-01-02" and got["end_date"] is None and got["reached_total"] == 4
    nobody = row[:4] + ("private",) + row[5:11] + ("{'society_name': None}",) + row[12:]
    assert D.projects(spark.createDataFrame([row, nobody], schema), reg, text="python").count() == 1
    hidden = spark.createDataFrame([row, row[:4] + ("private",) + row[5:]], schema)
    with pytest.raises(Exception, match="non-public"):
        D.projects(hidden, reg, text="python").collect()


def test_indexes_by_iso3(spark, reg):
    risk = spark.createDataFrame([
        ("AFG", "INFORM", "n", 7.5, 1, 1, "u", "", 2023), ("UTO", "INFORM", "n", 1.0, 1, 1, "u", "", 2023),
        ("AFG", "OTHER", "n", 2.0, 1, 1, "u", "", 2023)],
        "Iso3 string, IndicatorId string, IndicatorName string, IndicatorScore double, nodelevel int, ValidityYear int, "
        "Unit string, Note string, Year int")
    assert rows(D.risk_index(risk, reg)) == sorted([
        AFG + ("INFORM Risk Index", 7.5, 2023), (None,) * 4 + ("INFORM Risk Index", 1.0, 2023)], key=repr)
    schema = ("indicator struct<id: string, value: string>, country struct<id: string, value: string>, "
              "countryiso3code string, date string, value double, unit string, obs_status string, decimal int")
    def seen(code, iso3, year, value, label="l"):
        return ((code, label), ("XX", "c"), iso3, year, value, "", "", 0)
    wdi = spark.createDataFrame([
        seen("SP.POP.TOTL", "AFG", "2020", 10.0), seen("SP.POP.TOTL", "AFG", "2021", 9.0),
        seen("SP.POP.TOTL", "UTO", "2021", 9.0), seen("SP.POP.TOTL", "WLD", "2021", 9.0),
        seen("SP.POP.TOTL", "ALB", "2021", None), seen("SP.POP.TOTL", "ALB", "2021", 1.0, None), seen("ZZ", "ALB", "2021", 1.0)],
        schema)
    assert rows(D.development_indicators(wdi, reg)) == [
        AFG + ("Population, total", 10.0, 2020), AFG + ("Population, total", 9.0, 2021)]
    assert rows(D.development_indicators(wdi, reg, latest=True)) == [AFG + ("Population, total", 9.0, 2021)]
    cpi = spark.createDataFrame([("c", "AFG", "r", 2019, 16, 173, 5, 1.2), ("c", "AFG", "r", 2020, 19, 165, 5, 1.1),
                                 ("c", "XXX", "r", 2020, 50, 60, 5, 1.1)],
                                "country string, iso3 string, region string, year int, score int, rank int, sources int, "
                                "standardError double")
    assert rows(D.corruption_perception(cpi, reg), "entity_name", "iso3", "score", "year") == sorted([
        (AFG[0], "AFG", 16, 2019), (AFG[0], "AFG", 19, 2020), (None, "XXX", 50, 2020)], key=repr)
    assert rows(D.corruption_perception(cpi, reg, latest=True), "iso3", "score") == [("AFG", 19), ("XXX", 50)]
    body = spark.createDataFrame([('{"137506": {"AFG": {"2019": 0.4, "2020": 0.5}, "UTO": {"2020": 0.9}}, "9": {"AFG": {"2020": 1.0}}}',)],
                                 "body string")
    hdi = P.flatten_maps(body, "body")
    assert rows(D.human_development(hdi, reg, latest=True)) == [AFG + ("Human Development Index (HDI)", 0.5, 2020)]


def test_presence_law_youth(spark, reg):
    presence = spark.createDataFrame([("Sahel", True, "s", True, None), ("republic of albania", False, None, False, "d")],
                                     "country string, presence boolean, url string, key_operation boolean, description string")
    assert rows(D.field_presence(presence, reg)) == [ALB + (False, False, None, "d")]
    law = spark.createDataFrame([(" Zimbabwe", "7", "u", "text")], "country string, law_id string, url string, description string")
    assert rows(D.disaster_law(law, reg)) == [ZWE + ("7", "u", "text")]
    youth = spark.createDataFrame([("Zimbabwe RC", "r", "2017", "Yes", "No", "Yes", None)],
                                  "`National Society` string, Region string, Year string, `Youth Policy` string, "
                                  "`Youth Engagement Strategy` string, `Youth in GB` string, `Youth-led structure` string")
    assert rows(D.youth_engagement(youth, reg)) == [ZWE + (2017, "Yes", "No", "Yes", None)]


def test_evaluations(spark, reg):
    raw = spark.createDataFrame([(" Africa, Zimbabwe ,republic of albania", "T"), ("Global", "G"), (None, "N")],
                                "country string, title string")
    df = index_first(D.evaluations(raw, reg))
    assert rows(df) == sorted([
        (["Zimbabwe Red Cross Society", "Albanian Red Cross"], ["Zimbabwe", "Albania"], ["ZWE", "ALB"], ["Africa", "Europe"], "T"),
        ([], [], [], [], "G")], key=repr)
    with pytest.raises(Exception, match="Atlantis"):
        D.evaluations(spark.createDataFrame([("Atlantis", "T")], raw.schema), reg).collect()


def test_statutes(spark, reg, tmp_path):
    path = sheet(tmp_path, 'Board,,\r\nColours,,\r\n"1.\nNational Society (NS)",First,Second\r\n,,\r\n'
                           'Afghanistan,a,b\r\nAlbania,c,d\r\n,,\r\nZimbabwe,e,\r\n')
    df = index_first(D.statutes(DL.read_sheet(spark, path, 2, 4, last_column=8, numbered=True), reg))
    assert df.columns[4:] == ["First", "Second"]
    assert rows(df) == sorted([AFG + ("a", "b"), ALB + ("c", "d"), ZWE + ("e", None)])


def test_recognition_laws(spark, reg, tmp_path):
    path = sheet(tmp_path, ',Status\r\n National Society (NS) ,Law/other regulations in force \r\nAfghanistan,x\r\n'
                           'Albania,y\r\nZimbabwe,"z\r\n"\r\n')
    df = D.recognition_laws(DL.read_sheet(spark, path, 1, 2), reg)
    assert [r[:4] + (r[4].strip(),) for r in rows(df)] == sorted([AFG + ("x",), ALB + ("y",), ZWE + ("z",)])


def test_youth_trainings(spark, reg, tmp_path):
    path = sheet(tmp_path, 'U0,U1,U2,U3,U4,U5,U6\r\n,,,,,,\r\n,Country ,number of YABC trainings to date ,'
                           'number of peer educators /trainers ,peer educators ,trainers ,Comment \r\n'
                           ',Afghanistan ,1,2,3,4,good\r\n,Zimbabwe,5,6,7,8,\r\n,TOTAL,6,8,10,12,\r\n')
    raw = DL.read_sheet(spark, path, 2, 3, first_column=1)
    assert rows(D.youth_trainings(raw, reg)) == sorted([AFG + ("1", "3", "4", "good"), ZWE + ("5", "7", "8", None)])


def test_logistics_projects(spark, reg, tmp_path):
    path = sheet(tmp_path, "Country,Type,Indicator,Region\r\nAfghanistan,T1,R1,own\r\nZimbabwe,T2,R2,own\r\n")
    df = index_first(D.logistics_projects(DL.read_table(spark, path), reg))
    assert rows(df) == sorted([AFG + ("T1", "R1"), ZWE + ("T2", "R2")])
