import pyarrow as pa

from changeloom.llm import bpe, common, langid, minhash, toxicity


class Captured:
    """A DataFrame's stand-in that hands over the function of ``mapInArrow``."""

    columns, schema = ["doc_id", "text"], None

    def mapInArrow(self, run, schema):
        return run


def test_one_operator_at_a_time_remembers():
    minhash.shingle_set("some words that are hashed one by one")
    assert minhash._word_hash
    loaded = langid._load({"en": (b" some words ", b" more words ")})
    assert not minhash._word_hash and langid._compressors
    assert langid._load({"en": (b" some words ", b" more words ")}) is loaded
    first = bpe.model()
    assert not langid._compressors and bpe.model() is first
    toxicity.Model().score("some words")
    assert bpe._model.cache_info().currsize == 0
    a, b = minhash.shingle_set("some words"), dict(minhash._word_hash)
    assert (minhash.shingle_set("some words") == a).all() and minhash._word_hash == b


def test_kept_rows_leave_in_small_batches():
    texts = [None if i % 7 == 0 else f"{i} " * (1000 if i % 5 else 1) for i in range(6000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6000)), pa.array(texts)], ["doc_id", "text"])
    run = common.kept_by(Captured(), "text", lambda: lambda t: t is None or len(t) > 2500)
    out = list(run([batch, batch.slice(0, 0), batch.slice(5999)]))
    assert max(b.nbytes for b in out) < 2 * common.PART_BYTES < batch.nbytes
    want = [(i, t) for i, t in [*enumerate(texts), (5999, texts[5999])] if t is None or len(t) > 2500]
    assert [(r["doc_id"], r["text"]) for b in out for r in b.to_pylist()] == want
