"""The entry module without its optional parts."""

import subprocess
import sys

import pytest

from snapledger.plans import registry

BLOCK = """
import sys

class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name in {blocked!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry

print(len(entry.queries()), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("blocked", [{"xxhash"}, {"regex"}, {"snapledger.llm", "corpus_pipeline"}])
def test_core_queries_remain(blocked):
    import snapledger.plans.feature_queries  # noqa: F401
    import snapledger.plans.model_queries  # noqa: F401
    import snapledger.plans.reconcile_queries  # noqa: F401
    import snapledger.plans.scalar_queries  # noqa: F401
    import snapledger.plans.shaping_queries  # noqa: F401
    import snapledger.plans.source_queries  # noqa: F401

    found = subprocess.run([sys.executable, "-c", BLOCK.format(blocked=blocked)], capture_output=True, text=True, check=True)
    assert found.stdout.split() == [str(len(registry.QUERIES)), str(len(registry.ORACLES))]
