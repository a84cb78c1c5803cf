import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from panelloom.session import case_sensitive, get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tiny tables: compiling each plan would take longer than running it.
    conf = {"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false", "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    s = get_spark("tests", "local[4]", **{k.replace(".", "__"): v for k, v in conf.items()})
    s.sparkContext.setLogLevel("ERROR")
    case_sensitive(s)
    yield s
    s.stop()


def rows(df, *order):
    """Rows as tuples, sorted by all columns or in the given order."""
    got = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return got if order else sorted(got, key=lambda r: tuple((x is not None, str(x)) for x in r))
