import zipfile
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.config import EngineConfig
from depotlens.schemas import TRANSACTIONS
from depotlens.sources import workbook
from depotlens.sources.sales_log import sales_log
from depotlens.sources.transactions import LOG_HEADERS, load_checked, load_transactions

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def book(path, sheets, shared=None, prefix="", epoch_1904=False, absolute=False):
    """A workbook as other programs write it: {sheet name: sheet XML}."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        rels = "http://schemas.openxmlformats.org/package/2006/relationships"
        z.writestr("_rels/.rels", f'<Relationships xmlns="{rels}"><Relationship Id="a" Type="{REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{REL}"><workbookPr date1904="{int(epoch_1904)}"/><sheets>{names}</sheets></workbook>')
        target = "/xl/worksheets" if absolute else "worksheets"
        inner = "".join(f'<Relationship Id="rId{i}" Type="{REL}/worksheet" Target="{target}/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{rels}">{inner}</Relationships>')
        for i, xml in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/s{i}.xml", xml)
        if shared is not None:
            z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{shared}</sst>")
    return str(path)


def sheet(rows, dimension="", extra=""):
    return f'<?xml version="1.0"?><worksheet {MAIN} xmlns:x14ac="urn:x">{dimension}{extra}<sheetData>{rows}</sheetData></worksheet>'


@pytest.fixture(scope="module", autouse=True)
def known(spark):
    workbook.register(spark)


def read(spark, path, schema=None, **options):
    reader = spark.read.format("workbook").options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def test_shared_rich_and_inline_text_and_gaps(spark, tmp_path):
    shared = "<si><t>name</t></si><si><t>n</t></si><si><r><t>rich </t></r><r><rPr><b/></rPr><t xml:space='preserve'>text </t></r><rPh sb='0' eb='1'><t>HINT</t></rPh></si><si><t/></si><si><t>a&lt;b _x000D_&amp;</t></si>"
    rows = (
        '<row r="1" spans="1:4"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c><c r="AB1" t="inlineStr"><is><t>far</t></is></c></row>'
        '<row r="2" x14ac:dyDescent="0.25"><c r="A2" t="s"><v>2</v></c><c r="C2"><v>12</v></c></row>'
        '<row r="4"/><row r="5"><c r="AB5" t="str"><f>"x"</f><v>formula</v></c><c r="C5" t="e"><v>#N/A</v></c></row>'
        '<row r="6"><c r="A6" t="s"><v>3</v></c><c r="C6"><v>17850.0</v></c><c r="AB6" t="b"><v>1</v></c></row>'
        '<row r="9"><c r="A9" t="s"><v>4</v></c><c r="B9"><v>7</v></c></row>'
    )
    path = book(tmp_path / "a.xlsx", {"other": sheet(""), "log": sheet(rows, '<dimension ref="A1:AB9"/>')}, shared)
    want = [("rich text ", "12", None), (None, None, "formula"), ("", "17850", "true"), ("a<b \r&", None, None)]
    for step in (1, 2, 3, 100):
        df = read(spark, path, sheet="log", rows_per_partition=str(step))
        assert df.columns == ["name", "n", "far"] and df.rdd.getNumPartitions() == -(-9 // step)
        assert [tuple(r) for r in df.collect()] == want
    assert read(spark, path, sheet="log").select("far").where("far is not null").count() == 2
    with pytest.raises(Exception, match="no sheet 'none'"):
        read(spark, path, sheet="none").collect()


@pytest.mark.parametrize("stated", ["", '<dimension ref="A1:B3"/>', '<dimension ref="A1"/>', '<dimension ref="A1:B99999"/>'])
def test_a_wrong_or_missing_size_loses_no_row(spark, tmp_path, stated):
    # Rows and cells without references, too.
    rows = "<row><c t='inlineStr'><is><t>k</t></is></c></row>" + "".join(f"<row><c><v>{i}</v></c></row>" for i in range(5000))
    path = book(tmp_path / "b.xlsx", {"s": sheet(rows, stated)}, absolute=True)
    df = read(spark, path, "k long", rows_per_partition="1000")
    assert [r[0] for r in df.collect()] == list(range(5000))


def test_prefixed_names(spark, tmp_path):
    xml = '<x:worksheet xmlns:x="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><x:dimension ref="A1:A2"/><x:sheetData><x:row r="1"><x:c r="A1" t="inlineStr"><x:is><x:t>k</x:t></x:is></x:c></x:row><x:row r="2"><x:c r="A2"><x:v>5</x:v></x:c></x:row></x:sheetData></x:worksheet>'
    assert read(spark, book(tmp_path / "p.xlsx", {"s": xml}), "k int").collect() == [(5,)]


@pytest.mark.parametrize("epoch_1904,first", [(False, datetime(1899, 12, 30)), (True, datetime(1904, 1, 1))])
def test_types_and_dates(spark, tmp_path, epoch_1904, first):
    head = "".join(f"<c t='inlineStr'><is><t>{n}</t></is></c>" for n in ("t", "d", "p", "i", "b", "f", "s", "u"))
    row = "<c><v>40513.351388888892</v></c><c><v>40513</v></c><c><v>2.5499999999999998</v></c><c><v>6</v></c><c t='b'><v>0</v></c><c><v>1e-3</v></c><c><v>0.1</v></c><c t='d'><v>2010-12-01T08:26:00</v></c>"
    path = book(tmp_path / "t.xlsx", {"s": sheet(f"<row>{head}</row><row>{row}</row>")}, epoch_1904=epoch_1904)
    schema = "t timestamp_ntz, d date, p decimal(18,4), i int, b boolean, f double, s string, u timestamp_ntz, gone string"
    got = read(spark, path, schema).first()
    from datetime import timedelta

    moment = first + timedelta(days=40513, hours=8, minutes=26)
    assert tuple(got) == (moment, (first + timedelta(days=40513)).date(), Decimal("2.5500"), 6, False, 0.001, "0.1", datetime(2010, 12, 1, 8, 26), None)
    if not epoch_1904:
        assert workbook.convert("n", "59", T.DateType()) == date(1900, 2, 28)
        assert workbook.convert("n", "61", T.DateType()) == date(1900, 3, 1)


def test_rows_that_do_not_parse(spark, tmp_path):
    head = "".join(f"<c t='inlineStr'><is><t>{n}</t></is></c>" for n in LOG_HEADERS)
    good = "<c><v>536365</v></c><c t='inlineStr'><is><t>85123A</t></is></c><c/><c><v>{q}</v></c><c><v>40513.5</v></c><c><v>{p}</v></c><c><v>17850</v></c><c t='inlineStr'><is><t>EIRE</t></is></c>"
    cells = [("6", "2.55"), ("6.5", "2.55"), ("7", "1e30"), ("8", "0.5")]
    rows = "".join(f"<row>{good.format(q=q, p=p)}</row>" for q, p in cells)
    path = book(tmp_path / "m.xlsx", {"s": sheet(f"<row>{head}</row>{rows}")})
    log, malformed = load_checked(spark, path, "workbook")
    assert [(r["invoice_no"], r["quantity"], str(r["unit_price"]), r["customer_id"]) for r in log.collect()] == [
        ("536365", 6, "2.5500", 17850), ("536365", 8, "0.5000", 17850),
    ]
    raw = [r["raw"] for r in malformed.orderBy("line_no").collect()]
    assert len(raw) == 2 and '"6.5"' in raw[0] and '"1e30"' in raw[1] and "null" in raw[0]
    with pytest.raises(Exception, match="6.5"):
        load_transactions(spark, path, "workbook", mode="FAILFAST").collect()
    # The same for text files: the raw line is kept.
    (tmp_path / "log.csv").write_text(",".join(LOG_HEADERS) + "\n1,A,x,3,2010-12-01T08:26:00,2.5,1,EIRE\n2,B,y,many,2010-12-01T08:26:00,2.5,1,EIRE\n")
    log, malformed = load_checked(spark, str(tmp_path / "log.csv"), "csv")
    assert [r["invoice_no"] for r in log.collect()] == ["1"]
    assert [r["raw"] for r in malformed.collect()] == ["2,B,y,many,2010-12-01T08:26:00,2.5,1,EIRE"]
    with pytest.raises(ValueError, match="types of their own"):
        load_checked(spark, path, "parquet")


def test_log_written_from_the_given_tables_reads_back(spark, sf_dir, tmp_path):
    given = sales_log(spark, sf_dir, "part")
    names = {v: k for k, v in LOG_HEADERS.items()}
    folder = str(tmp_path / "log")
    given.withColumnsRenamed(names).repartition(3).write.format("workbook").option("rows_per_file", "1000").mode("overwrite").save(folder)
    back = load_transactions(spark, folder, "workbook", line_column="line_no", rows_per_partition="300")
    assert back.rdd.getNumPartitions() > 6
    assert back.schema.simpleString() == TRANSACTIONS.simpleString()
    columns = [f.name for f in TRANSACTIONS]
    given = given.select(*(F.col(f.name).cast(f.dataType) for f in TRANSACTIONS))
    assert back.count() == given.count()
    assert back.select(columns).exceptAll(given).isEmpty()
    # A second write replaces the first; an odd text survives.
    odd = spark.createDataFrame([("a\r\n\x01_x0041_ <&>\t ",), (None,)], "text string")
    odd.coalesce(1).write.format("workbook").mode("overwrite").save(folder)
    assert [r[0] for r in read(spark, folder).collect()] == ["a\r\n\x01_x0041_ <&>\t ", None]


def test_moments_keep_their_instant(spark, tmp_path):
    df = spark.sql("select timestamp'2011-03-27 01:30:00' as t, date'2011-03-27' as d, cast(1.5 as decimal(9,2)) as p, true as b")
    df.write.format("workbook").mode("overwrite").save(str(tmp_path / "w"))
    assert read(spark, str(tmp_path / "w"), df.schema).collect() == df.collect()


def test_daily_run_takes_the_format():
    assert EngineConfig().max_invalid_ratio == 0.02
    from depotlens.sources.transactions import DECLARED

    assert "workbook" in DECLARED


def test_plain_rows_are_read_and_written_by_column(spark, tmp_path, monkeypatch):
    from datetime import timedelta

    columns = "s string, n int, big long, p decimal(18,4), f double, b boolean, d date, t timestamp_ntz, u timestamp, e string"
    rows = [
        (["a", "&<>]]>", "_x0041_\x01\r\n ", "", None, "x:row><row/>"][i % 6], None if i % 5 == 0 else i - 50, 10**17 + i, Decimal(i) / 8,
         i / 3, i % 2 == 0, date(1999, 12, 31) + timedelta(i), datetime(2001, 1, 1) + timedelta(hours=i, microseconds=i % 97 == 96),
         datetime(2001, 1, 1), None)
        for i in range(20000)
    ]
    given = spark.createDataFrame(rows, columns).coalesce(1)
    folder = str(tmp_path / "p")
    given.write.format("workbook").mode("overwrite").save(folder)
    want = sorted(map(repr, given.collect()))
    for step in ("6000", "30000"):
        back = read(spark, folder, columns, rows_per_partition=step)
        assert sorted(map(repr, back.collect())) == want

    # Most rows do not go through the parser of single cells.
    plain = [(str(i), i, 10**17 + i, Decimal(i) / 8, i / 4, date(2001, 1, 1), datetime(2001, 1, 1, 5)) for i in range(5000)]
    names = "s string, n int, big long, p decimal(18,4), f double, d date, t timestamp_ntz"
    spark.createDataFrame(plain, names).coalesce(1).write.format("workbook").mode("overwrite").save(str(tmp_path / "q"))

    def never(*_):
        raise AssertionError("a plain cell was read by itself")

    source = workbook.WorkbookReader({"path": str(tmp_path / "q"), "rows_per_partition": "2000"}, spark.createDataFrame([], names).schema)
    parts = source.partitions()
    monkeypatch.setattr(workbook, "convert", never)
    monkeypatch.setattr(workbook.WorkbookReader, "_rows", never)
    assert [tuple(r.values()) for part in parts for batch in source.read(part) for r in batch.to_pylist()] == plain


def test_rows_by_column_agree_with_rows_by_cell(tmp_path):
    cells = [
        "<c/>", "<c><v>007</v></c>", "<c><v>12</v></c>", "<c><v>-0</v></c>", "<c><v>1e3</v></c>", "<c><v>1e30</v></c>", "<c><v>12345678901234</v></c>",
        "<c><v>2.5</v></c>", "<c><v>0.30000000000000004</v></c>", "<c><v>36892.25</v></c>", '<c t="b"><v>1</v></c>', '<c t="d"><v>2001-02-03T04:05:06</v></c>',
        '<c t="d"><v>2001-02-03</v></c>', '<c t="d"><v>0999-02-03T04:05:06.5</v></c>', '<c t="inlineStr"><is><t>a &amp;lt; _x0041_&gt;</t></is></c>',
        '<c t="inlineStr"><is><t> 17 </t></is></c>', '<c t="inlineStr"><is><t></t></is></c>', '<c t="inlineStr"><is><t>&#65;</t></is></c>', '<c t="str"><v>z</v></c>',
    ]
    kinds = "string", "int", "long", "double", "decimal(18,4)", "decimal(18,0)", "boolean", "date", "timestamp_ntz", "timestamp"
    schema = T.StructType([T.StructField(f"c{i}", T._parse_datatype_string(k)) for i, k in enumerate(kinds)] + [T.StructField(workbook.CORRUPT, T.StringType())])
    head = "<row>" + "".join(f'<c t="inlineStr"><is><t>c{i}</t></is></c>' for i in range(len(kinds))) + "</row>"
    for i, cell in enumerate(cells):
        rows = "".join("<row>" + c * len(kinds) + "</row>" for c in (cell, cell, "<c/>"))
        # Attributes of the rows send them the other way.
        slow = rows.replace("<row>", "<row ht='1'>")
        got = []
        for name, xml in (("a", head + rows), ("b", head.replace("<row>", "<row ht='1'>") + slow)):
            path = book(tmp_path / f"{name}{i}.xlsx", {"s": sheet(xml)})
            reader = workbook.WorkbookReader({"path": path}, schema)
            got.append([r for part in reader.partitions() for batch in reader.read(part) for r in batch.to_pylist()])
        assert got[0] == got[1] and len(got[0]) == 3, cell
