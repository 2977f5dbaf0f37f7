"""Workbooks read row by row."""

import tracemalloc
import zipfile

from notaflow.sources import files


def test_a_long_sheet_takes_little_memory(monkeypatch):
    rows = 60_000
    book = files.build_workbook({"Aba": [(r, c, f"valor {r} {c}") for r in range(rows) for c in range(2)]})
    monkeypatch.setattr(files, "SHEET_IN_MEMORY", 1 << 20)
    tracemalloc.start()
    n = sum(1 for cell in files.workbook_cells("a.xlsx", book) if cell[4] == f"valor {cell[2]} {cell[3]}")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2 * rows and peak < 8 << 20


def test_a_broken_long_sheet_is_skipped_whole(monkeypatch, tmp_path):
    good = files.build_workbook({"A": [(0, 0, "x"), (1, 0, "y")], "B": [(r, 0, "z") for r in range(500)]})
    (tmp_path / "a.xlsx").write_bytes(good)
    with zipfile.ZipFile(tmp_path / "a.xlsx") as z, zipfile.ZipFile(tmp_path / "b.xlsx", "w") as out:
        for n in z.namelist():
            data = z.read(n)
            out.writestr(n, data[:-40] if n.endswith("sheet2.xml") else data)
    broken = (tmp_path / "b.xlsx").read_bytes()
    small = files.decode_workbook("b.xlsx", broken)
    monkeypatch.setattr(files, "SHEET_IN_MEMORY", 0)
    assert files.decode_workbook("b.xlsx", broken) == small
    assert [c[1:5] for c in small if c[5] is None] == [("A", 0, 0, "x"), ("A", 1, 0, "y")]
    assert [c[1] for c in small if c[5]] == ["B"]
    assert files.decode_workbook("a.xlsx", good) == [("a.xlsx", "A", 0, 0, "x", None), ("a.xlsx", "A", 1, 0, "y", None)] + [
        ("a.xlsx", "B", r, 0, "z", None) for r in range(500)]
