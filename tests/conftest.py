"""One session for all tests, and the golden quarterly archive."""

from __future__ import annotations

import os
import sys
import zipfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chronofact.session import build_session, ship_package  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    yield s
    s.stop()


SUB = ["adsh cik name sic countryba stprba fye form period fy fp filed accepted prevrpt detail instance nciks".split()]
SUB += [
    ["0088-21-000417", "7731", "HOLLOW REED MILLING", "2040", "NO", "", "0630", "10-K", "20200630", "2020", "FY", "20210118", "2021-01-18 16:31:07", "0", "0", "reed-20200630_htm.xml", "1"],
    ["0088-21-002960", "7731", "HOLLOW REED MILLING", "2040", "NO", "", "0630", "10-K/A", "20200630", "2020", "FY", "20210607", "2021-06-07 08:12:55", "1", "0", "reed-20200630a_htm.xml", "1"],
    ["0088-22-000381", "7731", "HOLLOW REED GROUP", "2040", "NO", "", "0630", "10-K", "20210630", "2021", "FY", "20220121", "2022-01-21 17:02:40", "0", "1", "reed-20210630_htm.xml", "2"],
]
NUM = ["adsh tag version ddate qtrs uom segments coreg value footnote".split()]
NUM += [
    ["0088-21-000417", "ProfitLoss", "us-gaap/2019", "20200630", "4", "USD", "", "", "-64.5", ""],
    ["0088-21-000417", "Assets", "us-gaap/2019", "20200630", "0", "USD", "", "", "2210", ""],
    ["0088-21-002960", "ProfitLoss", "us-gaap/2019", "20200630", "4", "USD", "", "", "-80.625", "inventory corrected"],
    ["0088-21-002960", "Assets", "us-gaap/2019", "20200630", "0", "USD", "", "", "2210", "unchanged"],
    ["0088-22-000381", "ProfitLoss", "us-gaap/2021", "20210630", "4", "USD", "", "", "31", ""],
    ["0088-22-000381", "Assets", "us-gaap/2021", "20210630", "0", "USD", "", "", "2475", ""],
    ["0088-22-000381", "Assets", "us-gaap/2021", "20210630", "0", "USD", "PlantAxis=MossMillMember;", "", "940", ""],
    ["0088-22-000381", "Assets", "us-gaap/2021", "20210630", "0", "USD", "PlantAxis=FenMillMember;", "", "515", ""],
]


def write_archive(path, sub=SUB, num=NUM, more=("pre.txt", "tag.txt")) -> str:
    with zipfile.ZipFile(path, "w") as z:
        for name, rows in (("sub.txt", sub), ("num.txt", num)):
            if rows is not None:
                z.writestr(name, "\n".join("\t".join(r) for r in rows) + "\n")
        for name in more:
            z.writestr(name, "x\n")
    return str(path)


@pytest.fixture
def archive(tmp_path):
    return write_archive(tmp_path / "2025q1.zip")
