import json

import pytest

from tradeloom.session import build


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def land(tmp_path):
    """Write documents as landed pages `<folder>/p0.json`, `p1.json`, ... and return the folder."""
    def write(folder, *documents):
        target = tmp_path / folder
        target.mkdir(exist_ok=True)
        for i, doc in enumerate(documents):
            text = doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False)
            (target / f"p{i}.json").write_text(text, encoding="utf-8")
        return str(target)

    return write


@pytest.fixture
def rows():
    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=str)

    return collect
