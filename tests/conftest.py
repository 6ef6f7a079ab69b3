import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tillwise.session import local_session

    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        "*",
        app="tests",
        **{
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={base}",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def landing(tmp_path):
    """Write small text files: landing('in/a.csv', 'x,y', '1,2')."""

    def write(name, *lines):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(path)

    write.base = str(tmp_path)
    return write


def rows(df, *order):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))
