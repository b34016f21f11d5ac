"""What a worker keeps of one step is given back when another step runs in it."""

import weakref

import public_tokenizers
import pyarrow as pa

from dispatchlens.llm import chunks, jaccard, pieces
from dispatchlens.llm.queries import PIECES


def test_caches_leave_memory():
    encoder = weakref.ref(pieces._encoder(public_tokenizers.path(PIECES)))
    chunks.forget()
    assert encoder() is None and pieces.transducer.cache_info().currsize == 0


def test_the_join_gives_back_what_encoding_kept(spark):
    docs = spark.createDataFrame([(1, "some words of a text that is long enough to have shingles")], "doc_id long, text string").coalesce(1)

    def kept(batches):
        from dispatchlens.llm import pieces as here

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([here._encoder.cache_info().currsize], pa.int64())})

    def seen():
        return spark.range(1).coalesce(1).mapInArrow(kept, "n long").first()["n"]

    pieces.digests(docs, public_tokenizers.path(PIECES)).collect()
    assert seen() == 1
    jaccard._first(jaccard._texts(docs), "bigint").collect()
    assert seen() == 0
