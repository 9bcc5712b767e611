"""The driver contract where the training-data operators, or something they need, are missing."""

import subprocess
import sys

import pytest
from conftest import ROOT

from tallywright.plans import catalog
from tallywright.sources.scratch import shared

BLOCKED = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as contract
print(len(contract.queries()), len(contract.oracle_sql()))
"""


@pytest.mark.parametrize("name", ["tallywright.llm", "xxhash", "zstandard"])
def test_core_queries_stay_without_the_operators(name):
    run = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], cwd=ROOT, capture_output=True, text=True)
    assert run.stdout.split() == [str(len(catalog.queries()))] * 2, run.stderr


def test_a_missing_pipeline_costs_the_pipeline_only():
    import __spark_entry__ as contract

    run = subprocess.run([sys.executable, "-c", BLOCKED.format(name="corpus_pipeline")], cwd=ROOT, capture_output=True, text=True)
    assert int(run.stdout.split()[0]) == len(set(contract.queries()) - {"pipeline"}), run.stderr


@pytest.mark.parametrize("folder, master, fine", [
    ("file:/tmp/w", "local[4]", True), ("/tmp/w", "local-cluster[2,1,1024]", True), ("file:/tmp/w", "spark://h:7077", False),
    ("/tmp/w", "yarn", False), ("spark-warehouse", "yarn", False), ("hdfs://n/w", "yarn", True), ("s3a://b/w", "k8s://x", True),
])
def test_folders_on_one_machine_are_not_shared(folder, master, fine):
    assert shared(folder, master) == fine
