"""What sorted parts share is composed once, with the ids of parts encoded apart."""

import random

import public_tokenizers
import sentencepiece

from dispatchlens.llm import pieces
from dispatchlens.llm.queries import PIECES


class Counted(dict):
    looked_up = 0

    def get(self, key, default=None):
        self.looked_up += 1
        return super().get(key, default)


def test_common_starts_are_composed_once(monkeypatch):
    path = public_tokenizers.path(PIECES)
    model = pieces.Transducer(path)
    alone = pieces.Transducer(path)
    rng = random.Random(5)
    stems = ["▁internation", "▁überraschend", "▁consider", "▁日本語処", "▁x\U0001f600y"]
    texts = sorted({s + "".join(rng.choices("aeinrstl", k=rng.randint(0, 6))) for s in stems for _ in range(60)})
    want = [alone.path(t) for t in texts]
    assert [model.path(t) for t in texts] == want  # from here on both know all pairs
    monkeypatch.setattr(model, "arcs", Counted(model.arcs))
    monkeypatch.setattr(alone, "arcs", Counted(alone.arcs))
    assert list(model.paths(texts)) == want
    assert [alone.path(t) for t in texts] == want
    assert model.arcs.looked_up < alone.arcs.looked_up / 2
    rng.shuffle(texts)
    assert list(model.paths(texts)) == [alone.path(t) for t in texts]


def test_batches_of_words_with_common_starts_equal_the_library():
    path = public_tokenizers.path(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["inter internat international, internationals", "", "a", "an and; anderer\tandere", "und-und und" + "x" * 80, "und" + "x" * 79]
    assert [x.tolist() for x in pieces._ids(texts, path)] == [library.encode(t) for t in texts]
