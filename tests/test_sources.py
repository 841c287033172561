import contextlib
import csv
import html
import io
import json
import random
import urllib.parse

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from cauce.schemas import CATEGORY, EMPLOYMENT, GDP, LANDING, POPULATION, RAW, REGION
from cauce.sources import (
    html_rows,
    html_table,
    land,
    project_fields,
    read_delimited,
    read_dimensions,
    read_html_table,
    read_json_array,
    read_page_files,
    read_pages,
    read_xml_rows,
    records_from_json,
    unreadable_counts,
)
from cauce.sources.html import decode_references
from cauce.sources.paged import HttpPages, KeyRange, KeyReader, PagedJson, PageRange, PageReader, count_records
from cauce.sources.splits import xml_elements
from cauce.sources.typed import typed
from checks.stand_in import StoredPages, StoredServer
from helpers import plan, rows


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


# --- delimited, JSON, XML ----------------------------------------------------


def test_delimited_reads_quotes_markers_and_spaces(spark, tmp_path):
    path = put(
        tmp_path / "p.csv",
        'cod_depto,departamento,poblacion_2023\n5,"A ""b"", c", 7\n\n8,NA,\n11,  x,nan\n',
    )
    assert rows(read_delimited(spark, path, POPULATION)) == [
        (5, 'A "b", c', 7),
        (8, None, None),
        (11, "  x", None),
    ]


def test_delimited_pipe(spark, tmp_path):
    path = put(tmp_path / "r.txt", "cod_depto|departamento|region\n5|NARIÑO|a,b\n")
    assert rows(read_delimited(spark, path, REGION, sep="|")) == [(5, "NARIÑO", "a,b")]


@pytest.mark.parametrize(
    "text, message",
    [
        ("cod_depto,departamento,poblacion_2023\n5,A,x\n", "poblacion_2023: not a valid bigint: x"),
        ("cod_depto,poblacion_2023,departamento\n5,7,A\n", "header"),
        ("cod_depto,departamento,poblacion_2023\n5,A,7,8\n", "MALFORMED_RECORD"),
    ],
)
def test_delimited_raises(spark, tmp_path, text, message):
    path = put(tmp_path / "p.csv", text)
    with pytest.raises(Exception, match=message):
        read_delimited(spark, path, POPULATION).collect()


def test_delimited_line_breaks_in_quotes(spark, tmp_path):
    path = put(tmp_path / "r.csv", 'cod_depto,departamento,region\n5,"a\nb",c\n')
    assert rows(read_delimited(spark, path, REGION, multi_line=True)) == [(5, "a\nb", "c")]


def test_json_array_over_lines_and_files(spark, tmp_path):
    put(
        tmp_path / "j" / "a.json",
        '[\n {"cod_depto": 5,\n "num_municipios": 12, "other": 1},\n'
        ' {"cod_depto": 8, "categoria_departamento": null, "num_municipios": 1}\n]',
    )
    put(tmp_path / "j" / "b.json", '[{"cod_depto": 9, "departamento": "NA"}]')
    assert rows(read_json_array(spark, str(tmp_path / "j"), CATEGORY)) == [
        (5, None, None, 12),
        (8, None, None, 1),
        (9, "NA", None, None),
    ]


def test_byte_order_mark_is_no_text(spark, tmp_path):
    mark = "\ufeff"
    csv = put(tmp_path / "p.csv", f"{mark}cod_depto,departamento,poblacion_2023\r\n5,A,7\r\n")
    assert rows(read_delimited(spark, csv, POPULATION)) == [(5, "A", 7)]
    array = put(tmp_path / "a.json", f'{mark}[{{"cod_depto": 5, "num_municipios": 7}}]')
    for split in (False, True):
        assert rows(read_json_array(spark, array, CATEGORY, split)) == [(5, None, None, 7)]
    elements = put(tmp_path / "p.xml", mark + xml(department(5)))
    for split in (False, True):
        found = read_xml_rows(spark, elements, GDP, "departamento", split)
        assert rows(found) == [(5, "A & Ñ", 2, 3)]


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("value", ['"12"', "1.5", "3000000000", "[1]"])
def test_json_value_of_another_type_is_an_error(spark, tmp_path, value, split):
    path = put(tmp_path / "a.json", f'[{{"cod_depto": 1, "num_municipios": {value}}}]')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json_array(spark, path, CATEGORY, split).collect()


def test_json_array_in_parts(spark, tmp_path):
    """Parts of one file, whose objects are one or more to a line."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = ",\n".join(f'  {{"cod_depto": {i}, "departamento": "[a], b"}}' for i in range(3000))
        put(tmp_path / "j" / "a.json", f"[\n{lines}\n]\n")
        put(tmp_path / "j" / "b.json", '[{"cod_depto": -1}, {"cod_depto": -2}]')
        put(tmp_path / "j" / "c.json", "[]")
        df = read_json_array(spark, str(tmp_path / "j"), CATEGORY, split=True)
        assert df.rdd.getNumPartitions() > 3
        found = df.agg(F.count("*"), F.sum("cod_depto"), F.max("departamento")).first()
        assert tuple(found) == (3002, 2999 * 1500 - 3, "[a], b")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@contextlib.contextmanager
def small_parts(spark, size):
    """Files are read in parts of about ``size`` bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in settings:
            spark.conf.unset(name)


@pytest.mark.parametrize("size", [150, 1000, 10**8])
@pytest.mark.parametrize("indent", [None, 0, 3])
def test_json_arrays_of_any_layout_in_parts(spark, tmp_path, indent, size):
    source = random.Random(indent)
    letters = list('ab{}[],:"\\ \n\tñ😀')
    text = lambda: "".join(source.choices(letters, k=source.randint(0, 15)))
    schema = StructType().add("a", "long").add("b", "string").add("c", StructType().add("x", ArrayType(LongType())).add("y", "string"))
    for name, n in (("a.json", 90), ("b.json", 1), ("c.json", 0)):
        made = [{"a": i, "b": text(), "c": {"x": [1, i], "y": text()}} for i in range(n)]
        put(tmp_path / "j" / name, json.dumps(made, indent=indent, ensure_ascii=source.random() < 0.5) + "\n")
    whole = rows(read_json_array(spark, str(tmp_path / "j"), schema))
    assert len(whole) == 91
    with small_parts(spark, size):
        found = read_json_array(spark, str(tmp_path / "j"), schema, split=True)
        assert rows(found) == whole


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize(
    "text",
    ['{"error": true}', '[{"cod_depto": 1}', '[{"cod_depto": 1},{"a": "', "[1]", '[{"cod_depto": 1},]', "x",
     '[{"cod_depto": 1}{"cod_depto": 2}]', '[{"cod_depto": 1} 2]'],
)
def test_json_that_is_no_array_of_objects_is_an_error(spark, tmp_path, text, split):
    path = put(tmp_path / "a.json", text)
    with pytest.raises(Exception, match="JSON array|MALFORMED_RECORD"):
        read_json_array(spark, path, CATEGORY, split).collect()


@pytest.mark.parametrize("size", [60, 500, 10**8])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_delimited_with_line_breaks_in_parts(spark, tmp_path, end, size):
    source = random.Random(size)
    schema = StructType().add("a", "long").add("b", "string").add("c", "string")
    for name in ("x.csv", "y.csv"):
        file = io.StringIO()
        writer = csv.writer(file, lineterminator=end)
        writer.writerow(["a", "b", "c"])
        for i in range(70):
            text = ["".join(source.choices([*'ab," ñ|', end], k=source.randint(0, 12))) for _ in range(2)]
            writer.writerow([i, f"x{text[0]}x", f"{text[1]}z"])
        (tmp_path / "c").mkdir(exist_ok=True)
        (tmp_path / "c" / name).write_bytes(file.getvalue().encode())
    path = str(tmp_path / "c")
    whole = rows(read_delimited(spark, path, schema, multi_line=True))
    assert len(whole) == 140
    with small_parts(spark, size):
        assert rows(read_delimited(spark, path, schema, multi_line=True, split=True)) == whole


@pytest.mark.parametrize(
    "text, message",
    [
        ('a,b\n1,x\n2,"y\n', "quote is not closed"),
        ('a,b\n1,5" x\n2,6" y\n', "quote inside a field"),
        ("a,c\n1,x\n", "no header"),
        ("a,b\n1,x,y\n", "MALFORMED_RECORD"),
    ],
)
def test_delimited_in_parts_is_strict(spark, tmp_path, text, message):
    path = put(tmp_path / "p.csv", text)
    schema = StructType().add("a", "long").add("b", "string")
    with pytest.raises(Exception, match=message):
        read_delimited(spark, path, schema, multi_line=True, split=True).collect()


def xml(*rows_):
    return f"<?xml version='1.0'?><departamentos>{''.join(rows_)}</departamentos>"


def department(code, total="<pib_total_millones_cop>3</pib_total_millones_cop>"):
    return (
        f"<departamento><cod_depto>{code}</cod_depto><nombre>A &amp; Ñ</nombre>"
        f"<pib_percapita_cop>2</pib_percapita_cop>{total}</departamento>"
    )


def test_xml_rows(spark, tmp_path):
    path = put(tmp_path / "p.xml", xml(department(5), department(" 8 ")))
    assert rows(read_xml_rows(spark, path, GDP, "departamento")) == [
        (5, "A & Ñ", 2, 3),
        (8, "A & Ñ", 2, 3),
    ]


@pytest.mark.parametrize(
    "text, message",
    [
        (xml(department(5), department(8, "")), "pib_total_millones_cop: missing"),
        (xml(department("x")), "cod_depto: not a valid int: x"),
        (xml(department(5))[:-40], "MALFORMED_RECORD"),
    ],
)
def test_xml_is_strict(spark, tmp_path, text, message):
    path = put(tmp_path / "p.xml", text)
    with pytest.raises(Exception, match=message):
        read_xml_rows(spark, path, GDP, "departamento").collect()


@pytest.mark.parametrize("text", ["bare", "spaced"])
def test_xml_in_parts(spark, tmp_path, text):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        elements = [department(i) for i in range(2000)]
        if text == "spaced":
            elements = [e.replace("><", ">\n  <").replace("<nombre>", "<!-- c --><nombre>") for e in elements]
        path = put(tmp_path / "p.xml", xml(*elements) + "\n")
        df = read_xml_rows(spark, path, GDP, "departamento", split=True)
        assert df.rdd.getNumPartitions() > 3
        found = df.agg(F.count("*"), F.sum("cod_depto"), F.min("nombre")).first()
        assert tuple(found) == (2000, 1999 * 1000, "A & Ñ")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize(
    "text, message",
    [
        (xml(department(5), department(8, "")), "pib_total_millones_cop: missing"),
        (xml(department("x")), "cod_depto: not a valid int: x"),
        (xml(department(5))[:-40], "MALFORMED_RECORD"),
    ],
)
def test_xml_in_parts_is_strict(spark, tmp_path, text, message):
    path = put(tmp_path / "p.xml", text)
    with pytest.raises(Exception, match=message):
        read_xml_rows(spark, path, GDP, "departamento", split=True).collect()


XML_ODD = """<?xml version='1.0'?><!-- <departamento> --><d><?pi <departamento>?>
<departamento a="x > y" b='"'>{}</departamento><other><departamento2/></other>
<![CDATA[ </departamento> <departamento> ]]>
<!----><departamento
  c = '/departamento>'>{}<!-- </departamento> > --></departamento >text > more</d>"""


@pytest.mark.parametrize("size", [7, 64, 10**8])
def test_xml_of_any_layout_in_parts(spark, tmp_path, size):
    fields_ = "<cod_depto>{}</cod_depto><nombre><![CDATA[a>b</departamento>]]></nombre><pib_percapita_cop>2</pib_percapita_cop><pib_total_millones_cop>3</pib_total_millones_cop>"
    path = put(tmp_path / "x" / "p.xml", XML_ODD.format(fields_.format(5), fields_.format(8)))
    put(tmp_path / "x" / "q.xml", xml(department(9)))
    expected = [(5, "a>b</departamento>", 2, 3), (8, "a>b</departamento>", 2, 3), (9, "A & Ñ", 2, 3)]
    with small_parts(spark, size):
        found = read_xml_rows(spark, str(tmp_path / "x"), GDP, "departamento", split=True)
        assert rows(found) == expected
        inner = xml_elements(spark, path, "cod_depto")
        assert [r.text for r in inner.orderBy("text").collect()] == ["<cod_depto>5</cod_depto>", "<cod_depto>8</cod_depto>"]


def test_nested_and_empty_elements_in_parts(spark, tmp_path):
    texts = ["<r/>", "<r><r>1</r><r/></r>", '<r a="/"></r>', "<r a='>'/>"]
    path = put(tmp_path / "p.xml", f"<x>{' '.join(texts)}<rr><s/></rr></x>")
    with small_parts(spark, 3):
        assert sorted(r.text for r in xml_elements(spark, path, "r").collect()) == sorted(texts)


# --- HTML --------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><script>var t = "<table><tr><td>1</td></tr></table>";</script>
<style>table {}</style></head><body><!-- <table><tr><td>no</td></tr></table> -->
<TABLE id="t"><thead><tr><th>cod_depto</th><th> nombre </th><th>n</th></tr></thead>
<tbody>
  <tr class='a'><td>5</td><td><b>Nari&ntilde;o</b>
      &amp; m&#225;s</td><td>1,234,567</td></tr>
  <tr><td>8<td>open cells<td>2
  <tr><td>9</td><td>short</td></tr>
  <tr></tr>
</tbody></TABLE>
<table><tr><td>n</td></tr><tr><td>42</td></tr></table></body></html>"""

COLUMNS = StructType().add("n", "long").add("cod_depto", "integer").add("nombre", "string")


def pages(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, html string")


def test_html_table(spark):
    found = html_table(pages(spark, PAGE, "<p>none</p>"), COLUMNS)
    assert found.columns == ["doc_id", "row_no", "n", "cod_depto", "nombre"]
    assert rows(found) == [
        (0, 1, 1234567, 5, "Nariño & más"),
        (0, 2, 2, 8, "open cells"),
        (0, 3, None, 9, "short"),
    ]


def test_html_second_table_and_raw_rows(spark):
    second = html_table(pages(spark, PAGE), StructType().add("n", "integer"), table_index=1)
    assert rows(second) == [(0, 1, 42)]
    cells = html_rows(pages(spark, PAGE)).orderBy("row_no").collect()
    assert [len(r["cells"]) for r in cells] == [3, 3, 3, 2]
    assert cells[0]["cells"] == ["cod_depto", "nombre", "n"]


@pytest.mark.parametrize(
    "page, message",
    [
        ("<table><tr><td><table><tr><td>x</td></tr></table></td></tr></table>", "nested table"),
        ("<table><tr><td rowspan='2'>x</td></tr></table>", "spans rows or columns"),
        ("<table><tr><td colspan=12>x</td></tr></table>", "spans rows or columns"),
        ("<table><tr><th>a</th></tr><tr><td>1</td></tr></table>", "no column n"),
        ("<table><tr><th>n</th></tr><tr><td>x</td></tr></table>", "n: not a valid bigint: x"),
        ("<p>none</p>", "no table number 0"),
    ],
)
def test_html_raises_rather_than_misreads(spark, page, message):
    wanted = StructType().add("n", "long")
    with pytest.raises(Exception, match=message):
        html_table(pages(spark, page), wanted, required=True).collect()


def test_html_span_of_one_is_no_span(spark):
    page = "<table><tr><th>n</th></tr><tr><td colspan='1'>3</td></tr></table>"
    assert rows(html_table(pages(spark, page), StructType().add("n", "long"))) == [(0, 1, 3)]


SPANS = [
    # (rows of a table, the grid)
    ("<tr><td rowspan=2>a<td>b</tr><tr><td>c</td></tr>", ["ab", "ac"]),
    ("<tr><td colspan='2'>a</td><td>b</td></tr><tr><td>c<td>d<td>e</tr>", ["aab", "cde"]),
    ("<tr><td rowspan=2 colspan=2>a<td>b<tr><td>c<tr><td>d<td>e<td>f", ["aab", "aac", "def"]),
    ("<tr><td>a<td rowspan='3'>b<td>c</tr><tr><td>d<td>e</tr><tr><td rowspan=2>f</tr><tr><td>g", ["abc", "dbe", "fb", "fg"]),
    ("<tr><td>a<td>b<td rowspan=2>c</tr><tr><td>d</tr>", ["abc", "d-c"]),
    ("<tr><td rowspan=2>a</tr><tr></tr><tr><td>b</tr>", ["a", "a", "b"]),
    ("<thead><tr><th rowspan=9>a<th>b</thead><tbody><tr><td>c<td>d<tr><td>e", ["ab", "cd", "e"]),
    ("<tr><td rowspan=0>a<td>b</tr><tr><td>c</tr><tr><td>d</tr>", ["ab", "ac", "ad"]),
    ("<tr><td ROWSPAN = ' 02 '>a<td>b</tr><tr><td colspan=0>c</tr>", ["ab", "ac"]),
    ("<tr><td rowspan=99999999999>a<td>b</tr><tr><td>c</tr>", ["ab", "ac"]),
    ("<tr><td data-rowspan=1 colspan=2>a</tr>", ["aa"]),
]


def test_cells_that_span_rows_and_columns(spark):
    made = [f"<table>{body}</table>" for body, _ in SPANS]
    found = {}
    for r in html_rows(pages(spark, *made), spans=True).orderBy("doc_id", "row_no").collect():
        found.setdefault(r.doc_id, []).append("".join(c or "-" for c in r.cells))
    assert [found[i] for i in range(len(made))] == [grid for _, grid in SPANS]


def test_spanned_cells_give_values_by_column_name(spark):
    page = (
        "<table><tr><th>cod_depto<th colspan=2>n</tr><tr><td rowspan=2>5<td>1<td>x</tr>"
        "<tr><td>2<td>y</tr><tr><td>6<td colspan=2>3</tr></table>"
    )
    wanted = StructType().add("cod_depto", "integer").add("n", "long")
    assert rows(html_table(pages(spark, page), wanted, spans=True)) == [(0, 1, 5, 1), (0, 2, 5, 2), (0, 3, 6, 3)]


def test_random_spans_against_a_grid(spark):
    source = random.Random(5)
    made, expected = [], []
    for _ in range(60):
        width, height = source.randint(1, 5), source.randint(1, 6)
        grid, lines = [[None] * width for _ in range(height)], []
        for y in range(height):
            cells = []
            for x in range(width):
                if grid[y][x] is not None:
                    continue
                wide = 1
                while x + wide < width and grid[y][x + wide] is None and source.random() < 0.3:
                    wide += 1
                high = min(source.choice([1, 1, 2, 3]), height - y)
                name = f"{y}.{x}"
                for j in range(y, y + high):
                    grid[j][x : x + wide] = [name] * wide
                cells.append(f"<td rowspan={high} colspan='{wide}'>{name}</td>")
            lines.append(f"<tr>{''.join(cells)}</tr>")
        made.append(f"<table>{''.join(lines)}</table>")
        expected.append(grid)
    found = {}
    for r in html_rows(pages(spark, *made), spans=True).orderBy("doc_id", "row_no").collect():
        found.setdefault(r.doc_id, []).append(r.cells)
    assert [found[i] for i in range(len(made))] == expected


def test_character_references(spark):
    text = "a &lt;b&gt; &#65;&#x42; &#xD800; &bogus; &amp;lt; &#38;lt; & &; &#128512;"
    df = spark.createDataFrame([(text,), (None,), ("plain",)], "x string")
    found = [r[0] for r in df.select(decode_references(F.col("x"))).collect()]
    assert found == ["a <b> AB &#xD800; &bogus; &lt; &lt; & &; 😀", None, "plain"]


def test_random_tables_come_back(spark):
    """Escaped texts in many layouts of tags, against the texts they were made from."""
    source = random.Random(7)
    letters = list("ab Ñé<>&;#\"'\t\n\u00a0,.1/=-") + ["<td>", "</tr>", "&amp;", "<!--", "tr", "😀"]
    made, expected = [], []
    for _ in range(300):
        grid = [
            ["".join(source.choices(letters, k=source.randint(0, 12))) for _ in range(3)]
            for _ in range(source.randint(1, 6))
        ]
        closing = source.random() < 0.5
        cell = lambda t: f"<td class='x'>{html.escape(t)}" + ("</td>" if closing else "")
        lines = ["<tr>" + "".join(map(cell, r)) + ("</tr>\n" if closing else "\n") for r in grid]
        body = "".join(lines) if source.random() < 0.5 else f"<tbody>{''.join(lines)}</tbody>"
        made.append(f"<p>x</p><table>{body}</table><table><tr><td>other</td></tr></table>")
        expected.append([[" ".join(t.split()) for t in r] for r in grid])
    found = html_rows(pages(spark, *made)).collect()
    by_page = {}
    for r in sorted(found, key=lambda r: (r["doc_id"], r["row_no"])):
        by_page.setdefault(r["doc_id"], []).append(r["cells"])
    assert [by_page[i] for i in range(len(made))] == expected


def test_large_table_is_read_whole(spark):
    body = "".join(f"<tr><td>{i}</td></tr>" for i in range(20000))
    page = f"<table><tr><th>n</th></tr>{body}</table>"
    found = html_table(pages(spark, page), StructType().add("n", "long"))
    assert found.agg(F.count("n"), F.sum("n")).first()[:] == (20000, 19999 * 10000)


def test_five_dimensions_from_files(spark, tmp_path):
    page = (
        "<table><tr><th>cod_depto</th><th>departamento</th><th>tasa_desempleo_pct</th>"
        "<th>poblacion_ocupada</th></tr><tr><td>5</td><td>A</td><td>9.8</td><td>3,142</td></tr></table>"
    )
    found = read_dimensions(
        spark,
        put(tmp_path / "p.csv", "cod_depto,departamento,poblacion_2023\n5,A,10\n"),
        put(
            tmp_path / "c.json",
            '[{"cod_depto": 5, "departamento": "A", "categoria_departamento": "Z",'
            ' "num_municipios": 3}]',
        ),
        put(tmp_path / "r.txt", "cod_depto|departamento|region\n5|A|Sur\n"),
        put(tmp_path / "g.xml", xml(department(5))),
        put(tmp_path / "e.html", page),
    )
    assert [rows(d.table) for d in found] == [
        [(5, 10)],
        [(5, "Z", 3)],
        [(5, "Sur")],
        [(5, 2, 3)],
        [(5, 9.8, 3142)],
    ]
    assert [d.marker for d in found] == [
        "poblacion_2023", "categoria_departamento", "region", "pib_percapita_cop",
        "tasa_desempleo_pct",
    ]
    assert rows(read_html_table(spark, str(tmp_path / "e.html"), EMPLOYMENT)) == [
        (5, "A", 9.8, 3142)
    ]


# --- types ----------------------------------------------------------------------


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_typed_is_strict_in_either_mode(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("1", "NA"), (" 2 ", ""), (None, "NAN")], "n string, t string")
        wanted = StructType().add("n", "integer").add("t", "string")
        assert rows(typed(df, wanted)) == [(None, "NAN"), (1, "NA"), (2, "")]
        assert rows(typed(df, wanted, markers=True)) == [(None, "NAN"), (1, None), (2, None)]
        with pytest.raises(Exception, match="n: missing"):
            typed(df, wanted, required=True).collect()
        for text in ("1.5", "x", "3000000000", "1,000"):
            bad = spark.createDataFrame([(text, "")], df.schema)
            with pytest.raises(Exception, match=f"n: not a valid int: {text}"):
                typed(bad, wanted).collect()
        thousands = spark.createDataFrame([("1,000", "a,b")], df.schema)
        assert rows(typed(thousands, wanted, commas=True)) == [(1000, "a,b")]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_column_names_need_no_care(spark, tmp_path):
    name = "d'or \\ `x`.y"
    wanted = StructType().add(name, "integer").add("select", "string")
    path = put(tmp_path / "p.csv", f"{name},select\n5,a\n")
    assert rows(read_delimited(spark, path, wanted)) == [(5, "a")]
    page = f"<table><tr><th>select</th><th>{html.escape(name)}</th></tr><tr><td>b<td>6</tr></table>"
    assert rows(html_table(pages(spark, page), wanted)) == [(0, 1, 6, "b")]
    array = put(tmp_path / "a.json", json.dumps([{name: 7, "select": "c"}]))
    for split in (False, True):
        assert rows(read_json_array(spark, array, wanted, split)) == [(7, "c")]
    file = put(tmp_path / "p.html", page)
    assert rows(read_html_table(spark, file, wanted)) == [(6, "b")]
    bad = put(tmp_path / "q.csv", f"{name},select\nz,a\n")
    with pytest.raises(Exception, match="not a valid int: z"):
        read_delimited(spark, bad, wanted).collect()


# --- records -----------------------------------------------------------------


def test_land_types_and_absent_fields(spark):
    raw = spark.createDataFrame(
        [(1, "5", "12", "x"), (2, None, "n/a", "x"), (3, "7", "NaN", "x"), (4, "7", None, "x")],
        "id bigint, cod_depto string, cantidad string, extra string",
    )
    landed = land(raw)
    assert landed.schema.simpleString() == LANDING.simpleString()
    assert rows(landed.select("id", "cod_depto", "cantidad", "municipio")) == [
        (1, "5", 12.0, None),
        (2, None, None, None),
        (3, "7", None, None),
        (4, "7", None, None),
    ]
    assert raw.agg(unreadable_counts()).first()[0] == 2


def test_records_from_json(spark):
    texts = ['{"cod_depto": 5, "cantidad": 1.5, "x": [1]}', '{"municipio": "M"}']
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, json string")
    found = records_from_json(df, "json").select("id", "cod_depto", "cantidad", "municipio")
    assert rows(found) == [(0, "5", "1.5", None), (1, None, None, "M")]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        bad = spark.createDataFrame([(1, "{")], "id bigint, json string")
        records_from_json(bad, "json").collect()


def test_project_fields(spark):
    df = spark.createDataFrame([(1, "x")], "id bigint, other string")
    assert project_fields(df, RAW).columns == RAW.fieldNames()


# --- paged source ------------------------------------------------------------


def write_pages(folder, records, size):
    folder.mkdir(parents=True, exist_ok=True)
    for start in range(0, len(records), size):
        put(folder / f"offset={start}" / "part-0.json", json.dumps(records[start : start + size]))
        put(folder / f"offset={start}" / "_SUCCESS", "")
    return str(folder)


FIELDS = StructType().add("id", "long").add("a", "string").add("b", "string")


@pytest.mark.parametrize("count", [0, 3, 4, 5, 8, 11])
@pytest.mark.parametrize("per_task", ["1", "2"])
def test_pages_exact_multiple_short_last_and_none(spark, tmp_path, count, per_task):
    records = [{"a": i, "c": 1} | ({"b": "x"} if i % 2 else {}) for i in range(count)]
    path = write_pages(tmp_path / "pages", records, 4)
    df = read_pages(spark, FIELDS, StoredPages, path=path, limit="4", pagesPerTask=per_task)
    expected = [(i + 1, str(i), "x" if i % 2 else None) for i in range(count)]
    assert rows(df) == expected
    assert df.rdd.getNumPartitions() == max(1, -(-count // (4 * int(per_task))))


def test_first_records_only(spark, tmp_path):
    path = write_pages(tmp_path / "pages", [{"a": i} for i in range(11)], 4)
    df = read_pages(spark, FIELDS, StoredPages, path=path, limit="4", first="6")
    assert [r[0] for r in rows(df)] == [1, 2, 3, 4, 5, 6]
    assert df.rdd.getNumPartitions() == 2
    assert read_pages(spark, FIELDS, StoredPages, path=path, limit="4", first="50").count() == 11


def test_values_that_are_no_text_are_the_same_from_both_readers(spark, tmp_path):
    values = [True, False, None, 1e20, 1.50, 10**18, -0.0, {"ñ": [1, {"x": None}]}, [True, "a b"], "", " x "]
    path = write_pages(tmp_path / "pages", [{"a": v, "b": [v]} for v in values], 4)
    stored = rows(read_page_files(spark, path, FIELDS))
    assert rows(read_pages(spark, FIELDS, StoredPages, path=path, limit="4")) == stored
    assert rows(read_pages(spark, FIELDS, StoredPages, path=path, limit="4", key=":id")) == stored
    assert [r[1] for r in stored][:3] == ["true", "false", None]
    assert stored[7][1] == '{"ñ":[1,{"x":null}]}'


@pytest.mark.parametrize("count", [0, 4, 11])
def test_page_files_equal_the_paged_source(spark, tmp_path, count):
    records = [{"a": i, "c": 1} | ({"b": "x"} if i % 2 else {}) for i in range(count)]
    path = write_pages(tmp_path / "pages", records, 4)
    by_source = read_pages(spark, FIELDS, StoredPages, path=path, limit="4")
    assert rows(read_page_files(spark, path, FIELDS)) == rows(by_source)
    first = read_page_files(spark, path, FIELDS, first=6)
    assert [r[0] for r in rows(first)] == list(range(1, min(count, 6) + 1))
    if count:
        assert "PartitionFilters: [isnotnull(offset" in plan(read_page_files(spark, path, first=6))


def test_misplaced_page_file_is_an_error(spark, tmp_path):
    put(tmp_path / "pages" / "p.json", '[{"a": 1}]')
    with pytest.raises(Exception, match="pages must be in folders offset="):
        read_page_files(spark, str(tmp_path / "pages"), FIELDS).collect()


def test_page_file_that_is_no_array_is_an_error(spark, tmp_path):
    put(tmp_path / "pages" / "offset=0" / "p.json", '[{"a": 1}, {"a"')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_page_files(spark, str(tmp_path / "pages"), FIELDS).collect()


def test_unknown_field_types_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="a must be string"):
        wrong = StructType().add("a", "integer")
        read_pages(spark, wrong, StoredPages, path=str(tmp_path)).collect()


class GrowingPages:
    """A source that caps pages at 3 records and grew after it was counted."""

    def __init__(self, records, counted):
        self.records, self.counted = records, counted
        self.asked = []

    def count(self):
        return self.counted

    def fetch(self, offset, limit):
        self.asked.append((offset, limit))
        found = [{"a": str(i)} for i in range(self.records)]
        return json.dumps(found[offset : offset + min(limit, 3)])


def read_all(pages_, limit, per_task=1, total=None, first=None):
    """(id, a) of all records."""
    reader = PageReader(pages_, limit, per_task, total, first)
    found = [row for p in reader.partitions() for b in reader.read(p) for row in b.to_pylist()]
    return [
        {"id": page["place"] + i + 1} | record
        for page in found
        for i, record in enumerate(json.loads(page["body"]))
    ]


class ChangingServer:
    """Records by an ascending key, some of which come while pages are read."""

    def __init__(self, keys, coming=()):
        self.keys, self.coming = sorted(keys), list(coming)
        self.skipped = 0

    def count(self):
        return len(self.keys)

    def next_key(self, after, step):
        self.skipped = max(self.skipped, step - 1)
        found = [k for k in self.keys if after is None or k > after]
        return found[step - 1] if len(found) >= step else None

    def fetch_after(self, after, upto, limit):
        found = [k for k in self.keys if (after is None or k > after) and (upto is None or k <= upto)]
        if self.coming:
            self.keys = sorted([*self.keys, self.coming.pop()])
        return json.dumps([{"k": k} for k in found[:limit]])


def read_keys(reader):
    return [r["k"] for p in reader.partitions() for b in reader.read(p) for r in json.loads(b.to_pylist()[0]["body"])]


@pytest.mark.parametrize("per_task", [1, 3])
@pytest.mark.parametrize("count", [0, 1, 4, 5, 23])
def test_pages_by_key_survive_inserts(count, per_task):
    keys = [f"k{i:03d}" for i in range(0, 10 * count, 10)]
    coming = [f"k{i:03d}" for i in random.Random(count).sample([x for x in range(10 * count + 9) if x % 10], 8)]
    server = ChangingServer(keys, coming)
    found = read_keys(KeyReader(server, "k", 4, per_task, None))
    assert len(found) == len(set(found)) and set(keys) <= set(found) <= {*keys, *coming}
    assert server.skipped < 4 * per_task


def test_first_records_by_key():
    server = ChangingServer([f"k{i}" for i in range(10)])
    assert read_keys(KeyReader(server, "k", 4, 1, 6)) == [f"k{i}" for i in range(6)]
    assert len(read_keys(KeyReader(server, "k", 4, 1, 60))) == 10


@pytest.mark.parametrize("body", ['[{"k": 1}, {"k": 1}]', '[{"a": 1}]', '[{"k": null}]', '{"error": true}'])
def test_keys_must_be_unique_and_there(body):
    class Server:
        def fetch_after(self, after, upto, limit):
            return body

    with pytest.raises(ValueError, match="missing or not unique|no JSON array"):
        list(KeyReader(Server(), "k", 4, 1, None).read(KeyRange(0, None, None)))


def test_fewer_records_than_counted_are_an_error(spark, tmp_path):
    class LosingPages(StoredPages):
        """Loses the last record of each page after it was counted."""

        @classmethod
        def name(cls):
            return "losing_pages"

        def pages(self, limit):
            server = StoredServer(self.options["path"], limit)
            fetch = server.fetch_after
            server.fetch_after = lambda *asked: json.dumps(json.loads(fetch(*asked))[:-1])
            return server

    path = write_pages(tmp_path / "pages", [{"a": i} for i in range(11)], 4)
    assert count_records(StoredPages, path=path, limit="4") == 11
    with pytest.raises(ValueError, match="11 records were counted"):
        read_pages(spark, FIELDS, LosingPages, path=path, limit="4", key=":id")


def test_short_pages_are_completed_and_growth_is_read():
    source = GrowingPages(records=12, counted=10)
    found = read_all(source, limit=5)
    assert [r["id"] for r in found][:10] == list(range(1, 11))
    assert len({r["a"] for r in found}) == len(found)


def test_full_last_page_is_followed_by_an_empty_one():
    source = GrowingPages(records=6, counted=6)
    assert len(read_all(source, limit=3)) == 6
    assert source.asked == [(0, 3), (3, 3), (6, 3)]


def test_vanished_records_are_an_error():
    with pytest.raises(ValueError, match="no records at offset 4; 6 more were counted"):
        read_all(GrowingPages(records=4, counted=10), limit=10)


def test_non_array_page_is_an_error():
    class Broken:
        def fetch(self, offset, limit):
            return '{"error": true}'

    reader = PageReader(Broken(), 5, 1, 5, None)
    with pytest.raises(ValueError, match="no JSON array"):
        list(reader.read(PageRange(0, 5, True)))


def test_http_requests():
    seen = []

    def opener(address, timeout):
        query = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(address).query))
        seen.append((query, timeout))
        return io.BytesIO(b'[{"n": "7"}]' if "$select" in query else b'[{"a": 1}]')

    source = HttpPages("http://host.example/r.json?x=1", "fecha_hecho", opener)
    assert source.count() == 7
    assert source.fetch(50, 10) == '[{"a": 1}]'
    assert seen == [
        ({"x": "1", "$select": "count(*) as n"}, 30),
        ({"x": "1", "$limit": "10", "$offset": "50", "$order": "fecha_hecho"}, 30),
    ]


def test_http_requests_by_key():
    seen = []

    def opener(address, timeout):
        seen.append(dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(address).query)))
        return io.BytesIO('\ufeff[{":id": "it\'s"}]'.encode() if len(seen) < 3 else b"[]")

    source = HttpPages("http://host.example/r.json", ":id", opener)
    assert source.next_key(None, 50) == "it's"
    assert source.fetch_after("it's", 7, 10) == '[{":id": "it\'s"}]'
    assert source.next_key("it's", 50) is None
    assert seen == [
        {"$select": ":id", "$order": ":id", "$limit": "1", "$offset": "49"},
        {"$limit": "10", "$order": ":id", "$select": ":*,*", "$where": ":id > 'it''s' and :id <= 7"},
        {"$select": ":id", "$order": ":id", "$limit": "1", "$offset": "49", "$where": ":id > 'it''s'"},
    ]


def test_other_fetcher_by_subclass(spark):
    class Counting(PagedJson):
        @classmethod
        def name(cls):
            return "counting_pages"

        def pages(self, limit):
            class Source:
                def count(self):
                    return 7

                def fetch(self, offset, limit):
                    return json.dumps([{"a": i} for i in range(offset, min(7, offset + limit))])

            return Source()

    df = read_pages(spark, FIELDS.__class__(FIELDS.fields[:2]), Counting, limit="3")
    assert rows(df) == [(i + 1, str(i)) for i in range(7)]


def test_stored_server_answers_from_the_middle(tmp_path):
    path = write_pages(tmp_path / "pages", [{"a": i} for i in range(6)], 4)
    source = StoredServer(path, 4)
    assert json.loads(source.fetch(2, 4)) == [{"a": 2}, {"a": 3}]
    assert json.loads(source.fetch(4, 4)) == [{"a": 4}, {"a": 5}]
    for uri in (f"file://{path}", f"file:{path}"):
        assert StoredServer(uri, 4).count() == 6


def test_bounds_by_key_list_the_stored_pages_once(tmp_path):
    source = StoredServer(write_pages(tmp_path / "pages", [{"a": i} for i in range(41)], 4), 4)
    opened, opens = [], source._open
    source._open = lambda: opened.append(1) or opens()
    parts = KeyReader(source, ":id", 4, 1, None).partitions()
    assert [(p.after, p.upto) for p in parts] == [(a or None, a + 4 if a < 40 else None) for a in range(0, 44, 4)]
    assert len(opened) == 2  # the list of folders and the last page


def test_named_references_of_the_standard(spark):
    from cauce.sources.html import decode_references

    text = "S&atilde;o &ccedil; &ordm; &ndash; &iquest; &#233; &#x0000E9; &#0000000233; &nosuch; &frac12;"
    df = spark.createDataFrame([(text,)], "t string").select(decode_references(F.col("t")))
    assert df.first()[0] == "São ç º – ¿ é é é &nosuch; ½"


def test_counts_are_decimal_numbers(spark):
    texts = ["1", " 2.5 ", "1e3", "-.5", "1d", "2f", "0x1p3", "Infinity", "NaN", "1e999", None]
    df = spark.createDataFrame([(t,) for t in texts], "cantidad string")
    found = [r.cantidad for r in land(df).collect()]
    assert found == [1.0, 2.5, 1000.0, -0.5, *[None] * 7]
    assert df.agg(unreadable_counts()).first()[0] == 6


def test_stored_pages_must_be_arrays_one_per_folder(spark, tmp_path):
    folder = tmp_path / "offset=0"
    folder.mkdir()
    (folder / "a.json").write_text('{"error": true}')
    with pytest.raises(Exception, match="no JSON array"):
        read_page_files(spark, str(tmp_path)).collect()
    (folder / "a.json").write_text('\ufeff [{"cantidad": 1}]')
    assert read_page_files(spark, str(tmp_path)).count() == 1
    (folder / "b.json").write_text("[]")
    with pytest.raises(ValueError, match="more than one file"):
        read_page_files(spark, str(tmp_path))
