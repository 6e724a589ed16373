import gc
import weakref

import public_tokenizers
import pyarrow as pa

from filetrail.llm import pieces, resample, simhash, store

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_a_worker_holds_one_thing():
    made = []
    for key in "aabba":
        store.hold(key, lambda: made.append(key) or key)
    assert made == ["a", "b", "a"]
    store.let_go()
    store.hold("a", lambda: made.append("a"))
    assert made == ["a", "b", "a", "a"]


def test_other_tasks_free_a_model():
    texts = pa.record_batch([["some text"], [True]], names=["text", "chosen"])
    ids = pa.record_batch([[1], [1], ["some text"]], names=["doc_id", "version", "text"])
    for task in (lambda: resample._count(iter([texts]), 1 << 10), lambda: simhash._wide(iter([ids]), 5)):
        model = weakref.ref(pieces.load(MODEL))
        assert pieces.load(MODEL) is model()
        assert list(task())
        gc.collect()
        assert model() is None
