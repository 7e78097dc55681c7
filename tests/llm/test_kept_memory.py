"""What a Python worker of the pipeline still holds when its work is done."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]

PACKED = """
import gc, os
import numpy as np
import pyarrow as pa
import public_tokenizers
from curbline.llm import packing

def held():
    return int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE") >> 20

def texts(seed):
    words = np.random.default_rng(seed).integers(0, 26, (100_000, 9), np.uint8) + 97
    lines = [b" ".join(part).decode() for part in np.split(words.view("S9").ravel(), 500)]
    return pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(lines)], ["rid", "text"])

work = packing._pieces(public_tokenizers.path("word_bpe_49k.json"), 2048, 0)
pieces = sum(b.num_rows for b in work(iter([texts(0)])))
before = held()
for seed in range(1, 8):
    pieces += sum(b.num_rows for b in work(iter([texts(seed)])))
gc.collect()
print(pieces, held() - before)
"""


def test_a_packing_worker_keeps_little_of_many_different_words():
    out = subprocess.run([sys.executable, "-c", PACKED], cwd=REPO, capture_output=True, text=True, check=True).stdout
    pieces, grown = map(int, out.split())
    # 800,000 different words; about 110 MB were kept of seven of these batches.
    assert pieces >= 4000 and grown < 50


ARROW = """
import os
import pyarrow as pa
from curbline.llm.common import lean

def held():
    return int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE") >> 20

def work(batches):
    for batch in batches:
        parts = [pa.array(range(k, k + 4000)) for k in range(2000)]
        del parts
        yield batch

batch = pa.RecordBatch.from_arrays([pa.array([1])], ["n"])
def grown(run):
    before = held()
    assert [b.to_pydict() for b in run(iter([batch, batch]))] == [{"n": [1]}] * 2
    return held() - before
plain = grown(work)
assert grown(lean(work)) <= 0
print(plain, held())
"""


def test_freed_arrow_memory_goes_back():
    subprocess.run([sys.executable, "-c", ARROW], cwd=REPO, capture_output=True, text=True, check=True)
