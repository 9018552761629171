"""The 34-column template table of the validated system, as test fixtures.

Rules and fault fixtures are written by the tests as small CSV files; the
column list, the typed rule variant and the allowed template codes are
fixed values of the validated system.
"""

from __future__ import annotations

import csv
import os

# --- fixed values: template table columns (position order) -------------------
# (name, data_type, length, nullable)
TEMPLATE_COLUMNS = [
    ("template_code", "STRING", "32", False),
    ("sheet", "STRING", "255", True),
    ("data_type", "STRING", "32", True),
    ("excel_cell", "STRING", "4", True),
    ("column_x", "STRING", "5", False),
    ("row_y", "DECIMAL(8,4)", "10", False),
    ("data_name", "STRING", "32", False),
    ("idexcel", "DECIMAL(8,5)", "255", True),
    ("excname", "STRING", "255", True),
    ("coduni", "STRING", "255", True),
    ("date_data", "DATE", "255", True),
    ("axis", "STRING", "255", True),
    ("status", "INT", "255", True),
    ("idarea", "STRING", "255", True),
    ("idcurr", "STRING", "255", True),
    ("idsover", "STRING", "255", True),
    ("idprod", "STRING", "255", True),
    ("idisco", "STRING", "255", True),
    ("idbsi", "INT", "255", True),
    ("idsegm", "STRING", "255", True),
    ("idasli", "STRING", "255", True),
    ("idtmbuc", "STRING", "255", True),
    ("idscene", "STRING", "255", True),
    ("idencum", "STRING", "255", True),
    ("idisin", "STRING", "255", True),
    ("idmatur", "STRING", "255", True),
    ("idauxdi", "STRING", "255", True),
    ("auvame", "STRING", "255", True),
    ("curve", "STRING", "255", True),
    ("idmetr", "STRING", "255", True),
    ("version", "STRING", "255", True),
    ("load_date", "DATE", "255", True),
    ("tip_act", "STRING", "255", True),
    ("car_aux", "STRING", "255", True),
]
# --- fixed values: allowed template codes ------------------------------------
TEMPLATE_CODES = ["1", "2", "3", "4", "6", "8", "10", "11", "12", "15", "16", "17", "1_multi", "15_multi"]

NAMES = [c[0] for c in TEMPLATE_COLUMNS]


def passing_rows() -> list[dict]:
    """Ten rows, two (template_code, sheet) groups, every rule satisfied."""
    rows = []
    groups = [("1", "S1"), ("2", "S2")]
    names = ["data_as_of", "cristine_unit", "excel_title", "ccy_amount", "other"]
    for g, (code, sheet) in enumerate(groups):
        for k, dn in enumerate(names):
            i = g * len(names) + k
            rows.append({
                "template_code": code, "sheet": sheet, "data_type": "decimal",
                "excel_cell": f"{'abcde'[k]}{g + 1}", "column_x": f"_c{i}", "row_y": f"{i}.1234",
                "data_name": dn, "idexcel": "1.12345", "date_data": "2025-02-24 +01",
                "status": str(i), "idbsi": "7", "load_date": "2025-02-24 +01",
            })
    return rows


def write_csv(path: str, rows: list[dict], header: bool = True, names: list[str] | None = None) -> str:
    names = names or NAMES
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        if header:
            w.writerow(names)
        for r in rows:
            w.writerow(["" if r.get(n) is None else r.get(n) for n in names])
    return path
