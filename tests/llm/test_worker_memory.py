"""What a Python worker keeps once a heavy task has ended, in a process of its own."""

import subprocess
import sys

import pytest

HEAD = """
import random, re
import pandas, pyarrow as pa
from ledgerline.llm import bpe, quality_model
import public_tokenizers

def held():
    with open("/proc/self/smaps_rollup") as file:
        return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", file.read()))) / 1024

draw = random.Random(3)
letters = "abcdefghijklmnopqrstuvwxyz"

def batches(n, words, size=100):
    known = ["".join(draw.choices(letters, k=6)) for _ in range(50_000)]
    for first in range(0, n, size):
        texts = [" ".join(draw.choices(known, k=words)) for _ in range(size)]
        ids = range(first, first + size)
        yield pa.RecordBatch.from_pydict({"doc_id": list(ids), "text": texts, "label": [k % 2 for k in ids]})

def growth(task, *shape):
    for _ in task(batches(100, 10)):
        pass
    before = held()
    for _ in task(batches(*shape)):
        pass
    print(held() - before)
"""
TRAIN = """
quality_model.EPOCHS = 1
growth(quality_model._train, 1000, 500)
"""
ENCODE = """
class Ranks:
    value = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))

encode, decode = bpe._encoder(Ranks, public_tokenizers.PATTERN, ["doc_id"]), bpe._decoder(Ranks)
growth(lambda found: decode(encode(found)), 4000, 500, 1000)
"""


@pytest.mark.parametrize("task", [TRAIN, ENCODE])
def test_worker_returns_the_memory_of_a_heavy_task(task):
    done = subprocess.run([sys.executable, "-c", HEAD + task], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    # MB
    assert float(done.stdout) < 40


def test_a_task_that_gives_back_passes_rows_through(spark):
    from ledgerline.llm import rows

    table = spark.range(1000).repartition(3)
    out = table.mapInArrow(rows.giving_back(lambda batches: batches), "id long")
    assert sorted(r.id for r in out.collect()) == list(range(1000))
    assert table.limit(0).mapInArrow(rows.giving_back(lambda batches: batches), "id long").count() == 0
