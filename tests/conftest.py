import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from sparkmart.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(
        "tests",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__sql__shuffle__partitions="3",
        spark__default__parallelism="2",
        spark__driver__memory="4g",
    )


@pytest.fixture
def interpreted(spark):
    """Tiny tables spend most of their time in planning and compiling; spare them that."""
    settings = {
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        "spark.sql.adaptive.enabled": "false",
    }
    saved = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)
