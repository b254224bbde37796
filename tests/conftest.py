import gzip
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from changetide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write_dump(tmp_path):
    """Write a dump file of lines (text, or objects to be encoded) and return its path."""

    def write(name, lines, folder=None, packed=True):
        folder = folder or tmp_path / "dumps"
        folder.mkdir(exist_ok=True)
        path = folder / name
        text = "".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)
        with (gzip.open(path, "wb") if packed else open(path, "wb")) as out:
            out.write(text.encode())
        return str(path)

    return write


def change(number, dt="2025-12-13T18:10:00.123Z", domain="example.org", **more):
    meta = {"dt": dt, "id": f"m{number}", "domain": domain}
    event = {"meta": meta, "id": number, "type": "edit", "wiki": "enwiki", "user": "u", "bot": False, "title": "T"}
    event.update(more)
    return {k: v for k, v in event.items() if v is not None}


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
