"""Functions sent to tasks must not need this package on the executors' path."""

import subprocess
import sys

import numpy as np
from pyspark import cloudpickle

from panelspark.llm import bytes_, jaccard, langid, lm, packing, quality, repeats, sharding, topk

SHIPPED = [
    jaccard.signatures, jaccard.shingle_sets, langid._count, langid._places, lm._Tally, lm.Katz, packing._encoder,
    quality._bags, quality._scores, repeats.Seeds, repeats.repeated_windows, sharding.permute, topk.BlockSearch, bytes_.Words,
]


def test_functions_load_without_the_package(tmp_path):
    (tmp_path / "f").write_bytes(cloudpickle.dumps(SHIPPED))
    code = (
        "import pickle, numpy as np\n"
        "fs = pickle.load(open('f', 'rb'))\n"
        "h = np.arange(50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)\n"
        "out = list(fs[0](h, np.zeros(50, dtype=np.int64), np.array([50])))\n"
        "assert len(out) and 'panelspark' not in __import__('sys').modules\n"
    )
    subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, check=True)


def test_signatures_are_the_same_in_every_process():
    h = np.arange(50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = ([x.tolist() for part in jaccard.signatures(h, np.zeros(50, dtype=np.int64), np.array([50])) for x in part] for _ in range(2))
    assert a == b
