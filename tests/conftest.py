import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from bedfeed.operators.location import SiteTables  # noqa: E402
from bedfeed.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def site(spark):
    """A small site with every kind of table entry."""
    return SiteTables.from_maps(
        spark,
        beds={
            "K7??": "WK7", "K7??-01": "WK7", "4120-??": "20ICU", "ED??": "ED_UNIT", "EDH??": "ED_UNIT",
            "NCPACU??": "NC_PACU", "N??": "ED_UNIT", "WH-TEST": "TEST",
        },
        units={
            "4TN": ("NORTH", "7K WEST ICU"), "WK7": ("NORTH", "7K WEST ICU"), "G5ICU": ("NORTH", "5G ICU"),
            "20ICU": ("MID", "20ICU"), "41ICU": ("MID", "41ICU"), "PICU": ("MID", "PICU"),
            "ED_UNIT": ("CREEK", "ED_UNIT"), "NC_PACU": ("CREEK", "NC_PACU"), "TEST": ("TEST", "TEST"),
            "NLICU": ("ORTHO", "NLICU"), "EHPOHA": ("ORTHO", "EHPOHA"), "NLPACU": ("ORTHO", "NLPACU"),
            "CVICU": ("MID", "CVICU"), "CVPODS": ("MID", "CVPODS"), "ICUW": ("MID", "ICUW"),
            "MID-ANES-CART": ("MID", "MID-ANES-CART"), "10001021": ("NORTH", "4B NORTH"), "ICU": ("MID", "ICU"),
        },
        hospitals={"North Creek Hospital": "CREEK", "10001": "NORTH"},
    )
