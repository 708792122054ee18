"""Functions for the workers carry their code, so workers need not have the package."""
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from tradelake.llm import conversations, embedding_dedup, packing, runs, simhash, toxicity, warc

FUNCTIONS = [simhash.fingerprint, simhash._compare(2), embedding_dedup._query(0.98, 0.99), embedding_dedup._build(0.98, 0.99),
             conversations._settle, conversations._fold, runs.word_runs, toxicity.Grammar, warc.RecordReader]


@pytest.mark.parametrize("k", range(len(FUNCTIONS)))
def test_unpickles_without_the_package(tmp_path, k):
    path = tmp_path / "f.pkl"
    path.write_bytes(cloudpickle.dumps(FUNCTIONS[k]))
    code = (f"import sys, pickle; sys.path[:] = [p for p in sys.path if 'repo' not in p]\n"
            f"f = pickle.load(open({str(path)!r}, 'rb')); assert 'tradelake' not in sys.modules; assert callable(f)")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_a_function_runs_there(tmp_path):
    path = tmp_path / "f.pkl"
    path.write_bytes(cloudpickle.dumps((runs.word_runs, simhash.fingerprint, toxicity.Grammar(toxicity.Model({"x": 1.0})).clause)))
    code = (f"import sys, pickle; sys.path[:] = [p for p in sys.path if 'repo' not in p]\n"
            f"r, f, c = pickle.load(open({str(path)!r}, 'rb'))\n"
            "assert r(list('abababab')) == [(0, 8, 2)] and f('a b c') and c(['you', 'x']) > c(['an', 'x'])")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert packing is not None
