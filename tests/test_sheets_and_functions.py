"""Workbooks read back, by both ways; and the library's functions called from SQL."""

import datetime
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from barpath.functions import scoring, surface
from barpath.operators import names
from barpath.sources import sheets

DAY = datetime.date(2024, 2, 29)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.xlsx").write_bytes(sheets.workbook({"first & last": [["age", "bmass", "mu"], [7, 25.5, None, "x"], [], ["<b>", None, True], [DAY, "", "x"]], "two": [["only"]], "none": []}))
    (tmp_path / "b.xlsx").write_bytes(sheets.workbook({"two": [[None] * 27 + ["far"]]}))
    return str(tmp_path)


CELLS = [
    ("a", "first & last", 1, ["age", "bmass", "mu"]), ("a", "first & last", 2, ["7", "25.5", None, "x"]), ("a", "first & last", 4, ["<b>", None, "true"]), ("a", "first & last", 5, ["2024-02-29", "", "x"]),
    ("a", "two", 1, ["only"]), ("b", "two", 1, [None] * 27 + ["far"]),
]


def test_workbooks_are_read_back(spark, folder):
    spark.dataSource.register(sheets.SheetSource)
    for df in (sheets.read(spark, f"{folder}/*.xlsx"), spark.read.format("sheets").load(folder)):
        assert sorted((r.file.rpartition("/")[2][0], r.sheet, r.row, r.cells) for r in df.collect()) == CELLS
    source = spark.read.format("sheets").option("sheets", "two").load(folder)
    assert sorted(r.cells[-1] for r in source.collect()) == ["far", "only"] and source.rdd.getNumPartitions() == 2
    assert sheets.read(spark, f"{folder}/a.xlsx", ["two", "absent"]).count() == 1


def test_cells_as_other_programs_write_them(spark):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r9" Target="/xl/worksheets/s.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:x="u"><workbookPr date1904="1"/><sheets><sheet name="S" x:id="r9"/></sheets></workbook>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>guide</t></rPh></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm"/><numFmt numFmtId="171" formatCode="0.0 &quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
        cells = '<c t="s"><v>0</v></c><c t="inlineStr"><is><t>in</t></is></c><c t="str"><f>A1</f><v>sum</v></c><c t="e"><v>#N/A</v></c><c s="1"><v>0.5</v></c><c s="2"><v>3.5</v></c><c r="H1"/>'
        z.writestr("xl/worksheets/s.xml", f"<worksheet {main}><sheetData><row>{cells}</row></sheetData></worksheet>")
    df = spark.createDataFrame([("f", bytearray(out.getvalue()))], "path string, content binary")
    assert sheets.cells_of(df).first().cells == ["rich", "in", "sum", None, "1904-01-01 12:00:00", "3.5", None, None]


def test_factor_tables(spark):
    book = sheets.workbook({"u_men": [["age", "bmass", "mu", "sigma", "nu"], [7, 25, 39.5, 0.2, -1], [8, None, 1, 1, 1], [None, 30.5, 40, 0.2]], "s_wom": [["bmass", "mu"], [40, 90.5, 0.1, 0.5], ["note"]], "other": [["x"], [1, 2, 3, 4, 5]]})
    cells = sheets.cells_of(spark.createDataFrame([("f", bytearray(book))], "path string, content binary"))
    got = sorted((r.kind, r.gender, r.age or 0, float(r.bodyweight), r.mu, r.sigma, r.nu) for r in sheets.factors(cells, [("u_men", "u", "m", True), ("s_wom", "s", "f", False)]).collect())
    assert got == [("s", "f", 0, 40.0, 90.5, 0.1, 0.5), ("u", "m", 0, 30.5, 40.0, 0.2, None), ("u", "m", 7, 25.0, 39.5, 0.2, -1.0)]


def test_functions_from_sql(spark):
    spark.createDataFrame([("M", 40, 12, 1.5), ("M", 41, 12, 1.7)], "gender string, bodyweight_kg int, age int, factor double").createOrReplaceTempView("youth_factors")
    spark.createDataFrame([("u", "m", 12, "40.0", 100.0, 0.2, 0.5), ("s", "f", None, "60.5", 90.0, 0.2, 0.0)], "kind string, gender string, age int, b string, mu double, sigma double, nu double").withColumn("bodyweight", F.col("b").cast("decimal(5,1)")).createOrReplaceTempView("gamx_factors")
    spark.createDataFrame([(1, "2020-01-01", 90, 100, 190), (1, "2020-03-01", 80, 120, 200), (1, "2020-05-01", 99, 130, 229), (1, "2019-12-31", 300, 300, 600)], "lifter_id long, date string, best_snatch int, best_cj int, total int").createOrReplaceTempView("meet_results")
    people = spark.createDataFrame([(1, "Ann Lee", "7", "F", "c", None), (2, "Anna Leeds", None, "F", "c", "w"), (3, "Bo", "ann", None, "c", "w"), (4, "Ann Lee", "8", "F", None, "w")], "lifter_id long, athlete_name string, membership_number string, gender string, club_name string, wso string")
    people.createOrReplaceTempView("athletes")
    made = surface.register(spark)
    assert set(surface.SCALARS) | set(surface.LOOKUPS) | set(surface.TABLES) == set(made)
    one = lambda sql: spark.sql(f"SELECT {sql} AS x").first().x
    assert one("count_successful_attempts('80', '-85', NULL)") == 1 and one("calculate_bounce_back('-80', '80')") is True and one("calculate_bounce_back('x', '80')") is False
    assert float(one("text_to_numeric_safe('109+')")) == 109 and one("text_to_numeric_safe('---')") is None
    assert one("get_youth_factor_exact(12, 40, 'male')") == 1.5 and one("get_youth_age_factor_interpolated(12, 40.5D, 'M')") == 1.6 and one("get_youth_age_factor_interpolated(21, 40.5D, 'M')") == 1
    raw = spark.range(1).select(F.round(scoring.distribution_score(F.lit(120.0), F.lit(100.0), F.lit(0.2), F.lit(0.5)), 2).alias("x")).first().x
    assert one("get_gamx_score('u', 'Men', 12, 40.04D, 120D)") == pytest.approx(raw) and one("get_gamx_score('u', 'Men', 13, 40D, 120D)") is None and one("get_gamx_score('s', 'W', 99, 60.5D, 90D)") == pytest.approx(1000, abs=1e-2)
    assert one("calculate_ytd_best(1, '2020-04-01', 'snatch')") == 90 and one("calculate_ytd_best(1, '2020-04-01', 'total')") == 200
    row = spark.sql("SELECT * FROM calculate_meet_result_analytics(1, '2020-06-01', '80', '-85', '85', '100', '---', '0')").first()
    assert tuple(row) == (2, 1, 3, 99, 130, 229, False, True, False, False)
    found = [r.lifter_id for r in spark.sql("SELECT * FROM search_athletes('ann')").collect()]
    terms = spark.createDataFrame([(1, "ann")], "term_id int, term string")
    same = names.search_athletes(people.select("lifter_id", "athlete_name", "membership_number"), people.select("lifter_id", "gender", "club_name", "wso"), terms)
    assert found == [3, 1, 2] == [r.lifter_id for r in same.orderBy("place").collect()]


def test_workbooks_are_of_a_thousand_results(spark, sf, monkeypatch):
    from barpath.plans import registry

    books, cells_of = [], sheets.cells_of
    monkeypatch.setattr(sheets, "cells_of", lambda files, names: books.append(files) or cells_of(files, names))
    registry.QUERIES["src_11_factor_sheets"](spark, sf)
    results = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert books[0].count() <= results // 1000 + 1


def test_bests_until_a_date_are_looked_up_by_equality(spark):
    rows = [(1, "2020-01-05", 50, 60, 110), (1, "2020-01-05", 55, None, 100), (1, "2020-03-01", 40, 90, 130), (1, "2021-01-01", 10, 10, 20), (2, "2020-02-02", 99, 99, 198)]
    spark.createDataFrame(rows, "lifter_id long, date string, best_snatch int, best_cj int, total int").createOrReplaceTempView("meet_results")
    surface.register(spark)
    asked = [(1, "2020-01-04"), (1, "2020-01-05"), (1, "2020-02-02"), (1, "2020-12-31"), (1, "2021-01-01"), (3, "2020-01-05"), (1, None), (None, "2020-01-05")]
    spark.createDataFrame(asked, "a long, d string").createOrReplaceTempView("asked")
    out = spark.sql("SELECT a, d, calculate_ytd_best(a, d, 'snatch') s, calculate_ytd_best(a, d, 'cj') c, calculate_ytd_best(a, d, 'total') t FROM asked")
    known = lambda a, d, k: max((r[k] for r in rows if r[0] == a and d and r[1] <= d and r[1][:4] == d[:4] and r[k] is not None), default=None)
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(repr((a, d, *(known(a, d, k) for k in (2, 3, 4)))) for a, d in asked)
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert joins and not any("<= " in line for line in joins)


def test_a_task_writes_one_workbook_at_a_time(spark, sf, monkeypatch):
    """No group of a whole workbook goes to Python, where a batch held thousands of them, and none is parsed from more than a few megabytes."""
    from barpath.plans import registry

    books, cells_of = [], sheets.cells_of
    monkeypatch.setattr(sheets, "cells_of", lambda files, names: books.append(files) or cells_of(files, names))
    registry.QUERIES["src_11_factor_sheets"](spark, sf)
    assert "collect_list" not in books[0]._jdf.queryExecution().optimizedPlan().toString()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").removesuffix("b")) <= sheets.BATCH_BYTES
    keys = [r.path for r in books[0].select("path").collect()]
    assert len(keys) == len(set(keys)) > 1  # whole books
