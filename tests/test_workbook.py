import re
import zipfile

from lawloom.sources.publish import write_workbook


def test_a_long_text_goes_on_in_further_rows(tmp_path):
    long = "".join(chr(97 + i % 26) for i in range(70000))
    write_workbook(str(tmp_path / "w.xlsx"), ["a", "b"], [["x", long], [None, ""], [None, None]])
    with zipfile.ZipFile(tmp_path / "w.xlsx") as z:
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
    rows = [[re.sub("<[^>]*>", "", c) for c in re.findall(r"<c/>|<c .*?</c>", r)] for r in re.findall("<row>(.*?)</row>", sheet)]
    assert [len(r) for r in rows] == [2] * 6 and "".join(r[1] for r in rows[1:4]) == long
    assert [r[0] for r in rows] == ["a", "x", "", "", "", ""]
