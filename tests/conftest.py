import os
import sys
import uuid

import pytest
from pyspark import cloudpickle

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from transqa.operators.infer import AnswerStore, Inference  # noqa: E402
from transqa.session import build_session, ship_package  # noqa: E402
from transqa.sources.tables import StageTables  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4,3]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def tables(spark):
    return StageTables.scratch(spark)


class Calls:
    """A client that notes every prompt in a file of its own, and its calls read back."""

    def __init__(self, directory, answer):
        self.directory, self.answer = str(directory), answer
        # Python workers cannot import test modules, so their functions travel by value.
        cloudpickle.register_pickle_by_value(sys.modules[answer.__module__])

    def factory(self):
        directory, answer = self.directory, self.answer

        class Counting:
            def complete(self, endpoint, prompt):
                import os as _os
                import uuid as _uuid

                with open(_os.path.join(directory, _uuid.uuid4().hex), "w") as f:
                    f.write(f"{endpoint}\n{prompt}")
                return answer(endpoint, prompt)

        return Counting

    @property
    def prompts(self):
        notes = []
        for name in os.listdir(self.directory):
            with open(os.path.join(self.directory, name)) as f:
                notes.append(tuple(f.read().split("\n", 1)))
        return sorted(notes)


@pytest.fixture
def counting(tmp_path):
    def make(answer=lambda endpoint, prompt: f"{endpoint}:{prompt}"):
        place = tmp_path / f"calls_{uuid.uuid4().hex}"
        place.mkdir()
        return Calls(place, answer)

    return make


@pytest.fixture
def inference(tables):
    def make(calls, **options):
        return Inference(calls.factory(), AnswerStore(tables), **options)

    return make
