import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import words as W
from tillroll.llm.ship import BATCH_BYTES, ship

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ09 \t\n\x0b\x0c\r.,-é漢\x00|", max_size=40)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(0, 3))
def test_words_equal_a_plain_split(values, skip):
    array = pa.array(values, pa.string()).slice(min(skip, len(values)))
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), v or "") for v in array.to_pylist()]
    for table, pattern in ((W.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (W.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found = W.words_of(array, table)
        got = [bytes(found.data[a:b]).decode() for a, b in zip(found.start, found.end)]
        expected = [re.findall(pattern, v) for v in lowered]
        assert got == [w for ws in expected for w in ws]
        assert found.counts().tolist() == [len(ws) for ws in expected]
        hashes = dict(zip(got, found.hashes().tolist()))
        assert len(set(hashes.values())) == len(hashes)
        assert [hashes[w] for w in got] == found.hashes().tolist()


def test_hashes_do_not_depend_on_what_stands_around(monkeypatch):
    monkeypatch.setattr(W, "CHUNK_BYTES", 16)
    long = W.words_of(pa.array(["x " * 50 + "the end", "a" * 100 + " the"])).hashes()
    assert long[50] == long[-1] == W.words_of(pa.array(["the"])).hashes()[0]
    assert np.unique(long).size == 4


def test_chunks_cover_all_rows_once():
    batch = pa.RecordBatch.from_pydict({"i": list(range(9)), "text": ["a" * n for n in (5, 0, 90, 3, 3, 3, 200, 0, 1)]})
    parts = list(W.chunks(iter([batch, batch.slice(0, 0)]), "text", 10))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(9))
    assert all(p.num_rows == 1 or p.column(1).nbytes <= 100 for p in parts)


def test_a_worker_gets_texts_in_small_batches(spark):
    texts = ship(spark).range(0, 30, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    sizes = [r.n for r in texts.mapInArrow(lambda batches: (pa.record_batch({"n": [b.nbytes]}) for b in batches), "n bigint").collect()]
    assert sum(sizes) >= 30 << 20 and max(sizes) <= 2 * BATCH_BYTES


def test_powers_are_kept_for_a_chunk_only():
    powers = W._Powers()
    assert [len(x) for x in powers.upto(10)] == [W.CHUNK_BYTES + 1] * 2
    assert [len(x) for x in powers.upto(2 * W.CHUNK_BYTES)] == [2 * W.CHUNK_BYTES] * 2
