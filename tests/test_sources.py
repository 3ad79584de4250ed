"""Sources read by parts: CSV by byte ranges, workbooks by sheets."""

import csv
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from matchloom.sources import files, split_csv


def test_line_states():
    """Against Python's csv, character by character: a line ends inside quotes if one more line would belong to its record."""
    rng = random.Random(1)
    for _ in range(4000):
        line = "".join(rng.choice(['"', ",", "a", '""', " "]) for _ in range(rng.randint(0, 9)))
        for inside in (False, True):
            text = ('x,"' if inside else "") + line + "\nTAIL"
            more = len(list(csv.reader(io.StringIO(text, newline="")))) == 1
            assert split_csv.ends_inside(line.encode(), inside) == more, (line, inside)


def sheet(rng, n):
    cell = lambda: rng.choice(["", "plain", "가나다", 'say "hi"', "a\nb", "a\r\n\r\nb", ",", '"', "긴" * rng.randint(0, 30), "x\n\ny\n" * rng.randint(0, 6)])
    return [[f"{i}", *(cell() for _ in range(3))] for i in range(n)]


@pytest.mark.parametrize("encoding,size", [("cp949", 300), ("utf-8", 64), ("utf-8-sig", 7), ("cp949", 1_000_000)])
def test_quoted_breaks_across_ranges(spark, tmp_path, encoding, size):
    rng = random.Random(size)
    want = []
    for k in range(2):
        rows = sheet(rng, 60 if size > 7 else 12)
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator="\r\n" if k else "\n").writerows([["No ", "a", "b", "c"], *rows])
        (tmp_path / f"{k}.csv").write_bytes(out.getvalue().encode(encoding))
        want += [tuple(r) for r in rows]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got, used = split_csv.read_csv_split(spark, str(tmp_path), ("utf-8-sig", "cp949"), with_place=True)
        assert used == ("cp949" if encoding == "cp949" else "utf-8-sig") and got.columns[:4] == ["No", "a", "b", "c"]
        rows = got.orderBy("_file", "_block", "_place").collect()
        assert [tuple(r)[:4] for r in rows] == want
        if size <= 300:
            assert len({(r._file, r._block) for r in rows}) > 4
            assert split_csv._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_odd_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'a,b\n\n1,"open\nnever,closed\n')
    got, _ = split_csv.read_csv_split(spark, f"{tmp_path}/a.csv", ("utf-8",))
    assert [tuple(r) for r in got.collect()] == [("1", "open\nnever,closed")]
    (tmp_path / "b.csv").write_bytes(b"a,b\n , \n5\" x,y\n7\n")
    got, _ = files.read_csv_any(spark, f"{tmp_path}/b.csv")
    assert [tuple(r) for r in got.collect()] == [('5" x', "y"), ("7", None)]
    (tmp_path / "c.csv").write_bytes(b"")
    with pytest.raises(ValueError, match="no header"):
        files.read_csv_any(spark, f"{tmp_path}/c.csv")
    (tmp_path / "d.csv").write_bytes(b"x,y\n1,2\n")
    with pytest.raises(ValueError, match="several headers"):
        files.read_csv_any(spark, f"{tmp_path}/[bd].csv")


def test_sheets_are_dealt_out(spark, tmp_path):
    for book in ("one", "two"):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            z.writestr("xl/workbook.xml", "<workbook><sheets>" + "".join(f'<sheet name="s{i}"/>' for i in range(6)) + "</sheets></workbook>")
            z.writestr("xl/sharedStrings.xml", "<sst><si><t>shared</t></si><si><r><t>in</t></r><r><t>side</t></r></si></sst>")
            for i in range(6):
                z.writestr(f"xl/worksheets/sheet{i + 1}.xml", "<worksheet><sheetData>" + "".join(f'<row r="{n}"><c r="A{n}" t="s"><v>{n % 2}</v></c><c r="C{n}"><v>{i * n}</v></c></row>' for n in range(1, 30)) + "</sheetData></worksheet>")
        (tmp_path / f"{book}.xlsx").write_bytes(held.getvalue())
    got = files.read_sheets(spark, f"{tmp_path}/*.xlsx", tasks=24)
    rows = {(r.path.split("/")[-1], r.sheet, r.row_no): r.cells for r in got.collect()}
    assert rows == {(f"{b}.xlsx", f"s{i}", n): ["inside" if n % 2 else "shared", "", str(i * n)] for b in ("one", "two") for i in range(6) for n in range(1, 30)}
    assert got.select("path", "sheet", F.spark_partition_id().alias("p")).distinct().select("p").distinct().count() > 4
    some = files.read_sheets(spark, f"{tmp_path}/one.xlsx", only=(2,)).where("sheet = 's3' and row_no = 5").first()
    assert some.cells == ["", "", "15"]
    book = b'<?xml version="1.0"?><Workbook xmlns="urn:x" xmlns:ss="urn:y"><Styles/><Worksheet ss:Name="A &amp; B"><Table><Row ss:Index="4"><Cell><Data>a</Data></Cell></Row></Table></Worksheet><Worksheet ss:Name="C"><Table><Row><Cell ss:Index="2"><Data>b</Data></Cell></Row></Table></Worksheet></Workbook>'
    (tmp_path / "old.xml").write_bytes(book)
    got = files.read_sheets(spark, f"{tmp_path}/old.xml", "spreadsheetml")
    assert sorted((r.sheet, r.row_no, r.cells) for r in got.collect()) == [("A & B", 4, ["a"]), ("C", 1, ["", "b"])]
