import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tillflow.session import build_session
    session = build_session("tillflow-tests", "local[8]", shuffle_partitions=8,
                            **{"spark.ui.enabled": "false", "spark.driver.memory": "8g",
                               "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")), "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples, for small results."""
    return sorted(tuple(r[c] for c in cols or df.columns) for r in df.collect())
