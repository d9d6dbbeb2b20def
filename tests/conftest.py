import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from vacantia.runtime import get_spark

    s = get_spark("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def data():
    if not DATA.exists():
        pytest.skip("no test tables here")
    return str(DATA)


@pytest.fixture(scope="session")
def duck(data):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in Path(data).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con
