import zipfile

import pytest

from gridloom.sources import spreadsheet as sp
from gridloom.sources.metadata import read_metadata
from gridloom.sources.readers import read_table

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def letters(i):
    return (chr(64 + i // 26) if i >= 26 else "") + chr(65 + i % 26)


def write_book(path, sheets, shared=True):
    """A workbook as office programs write it: texts in a shared table or in the cells; None: no cell."""
    strings = []

    def cell(value, row, column):
        ref = f"{letters(column)}{row}"
        if value is None:
            return ""
        if isinstance(value, bool):
            return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f'<c r="{ref}"><v>{value!r}</v></c>'
        if value.startswith("#"):
            return f'<c r="{ref}" t="e"><v>{value}</v></c>'
        text = value.replace("&", "&amp;").replace("<", "&lt;")
        if shared:
            strings.append(f"<si><r><t>{text[:1]}</t></r><r><t>{text[1:]}</t></r><rPh><t>no</t></rPh></si>" if len(strings) % 2 else f"<si><t>{text}</t></si>")
            return f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{text}</t></is></c>'

    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        names = list(sheets)
        for i, name in enumerate(names):
            rows = "".join(f'<row r="{r}">{"".join(cell(v, r, c) for c, v in enumerate(row))}</row>' for r, row in enumerate(sheets[name], 1))
            book.writestr(f"xl/worksheets/sheet{i + 1}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{rows}</sheetData></worksheet>')
        listed = "".join(f'<sheet name="{n}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{RELATIONS}"><sheets>{listed}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="rId{i + 1}" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names)))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{targets}</Relationships>")
        if shared:
            book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{"".join(strings)}</sst>')


WIDE = [
    [None, "age", "city", "city", "flag", "left"],
    ["type", "float", "category", "category", "bool", "number"],
    ["use", 1, 1, 0, 1, 1],
    ["imputation", "mean", "most_frequent", None, "zero", "Leave as N/A"],
    ["Category_transformation", None, "One-Hot", None, None, None],
    ["super_category", "who", "where", "where", "what", "what"],
]
LONG = [
    ("age", "float", 1, "mean", "", "who"), ("city", "category", 1, "most_frequent", "One-Hot", "where"), ("city.1", "category", 0, "", "", "where"),
    ("flag", "bool", 1, "zero", "", "what"), ("left", "number", 1, "Leave as N/A", "", "what"),
]


@pytest.mark.parametrize("shared", [True, False])
def test_wide_sheet(spark, tmp_path, shared):
    path = tmp_path / "meta.xlsx"
    write_book(path, {"Features": WIDE, "Other": [["x"], [1]]}, shared)
    assert [tuple(r) for r in read_metadata(spark, str(path)).collect()] == LONG


@pytest.mark.parametrize("label", [None, "what"])
def test_rows_by_position(spark, tmp_path, label):
    """Without known labels the rows count in their order, as in a sheet that was written without them."""
    rows = [[None, *r[1:]] if label else r[1:] for r in WIDE]
    if label:
        rows = [[None if i == 0 else f"row {i}", *r[1:]] for i, r in enumerate(WIDE)]
    write_book(tmp_path / "meta.xlsx", {"S": [*rows, [None, "a note"]]})
    assert [tuple(r) for r in read_metadata(spark, str(tmp_path / "meta.xlsx")).collect()] == LONG


def test_long_sheet_and_errors(spark, tmp_path):
    head = ["feature_name", "type", "use", "imputation", "transformation", "super_category"]
    write_book(tmp_path / "long.xlsx", {"S": [head, *[list(r) for r in LONG]]})
    assert [tuple(r) for r in read_metadata(spark, str(tmp_path / "long.xlsx")).collect()] == LONG
    with pytest.raises(FileNotFoundError):
        read_metadata(spark, str(tmp_path / "none.xlsx"))
    with pytest.raises(Exception, match="no sheet"):
        sp.read_spreadsheet(spark, str(tmp_path / "long.xlsx"), "T")


def test_cells_of_a_data_sheet(spark, tmp_path):
    rows = [["id", "n", "t", None, "b"], [1, 0.1, "a < b & c", "é", True], [2, 1e30, "NA", None, False], [None], [2**53 - 1, -3.0, "#N/A", "x"]]
    rows += [[i, i / 7, f"text {i % 50}", None, None] for i in range(25_000)]
    write_book(tmp_path / "data.xlsx", {"First": [["no"]], "Data": rows})
    df = sp.read_spreadsheet(spark, str(tmp_path / "data.xlsx"), "Data")
    got = [tuple(r) for r in df.orderBy(sp.ROW).collect()]
    assert df.columns == [sp.ROW, "id", "n", "t", "Unnamed: 3", "b"]
    assert got[:3] == [(0, "1", "0.1", "a < b & c", "é", "True"), (1, "2", "1e+30", "NA", None, "False"), (2, str(2**53 - 1), "-3", None, "x", None)]
    assert len(got) == 25_003 and got[-1] == (25_002, "24999", repr(24999 / 7), "text 49", None, None)
    write_book(tmp_path / "one.xlsx", {"Data": rows[:5]})
    table = read_table(spark, "excel", str(tmp_path / "one.xlsx"), infer=True)
    assert dict(table.dtypes)["id"] == "bigint" and [r["t"] for r in table.collect()] == ["a < b & c", None, None]
    assert sp.column_number("A1") == 0 and sp.column_number("AA7") == 26 and sp.column_number("XFD1") == 16383
