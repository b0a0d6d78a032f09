"""What the encoder judges again, and that its ids stay the library's."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from starflow.llm import pieces

MODEL = "piece_bpe_32k.model"


def prose(seed, words):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices("etaoinshr", k=rnd.randint(1, 12))) for _ in range(words))


def test_a_judged_pair_is_not_judged_again(monkeypatch):
    model = pieces.Model(public_tokenizers.path(MODEL))
    asked, plain = [], model._judge
    monkeypatch.setattr(model, "_judge", lambda a, b: asked.append(len(a)) or plain(a, b))
    first, second = np.array([300, 301, 302]), np.array([400, 401, 402])
    before = model.apart(first, second)
    assert model.apart(first, second).tolist() == before.tolist() == plain(first, second).tolist()
    assert asked == [3]


@pytest.mark.parametrize("bits", [1, 20])
def test_slots_that_collide_do_not_change_ids(monkeypatch, bits):
    monkeypatch.setattr(pieces, "PAIR_BITS", bits)
    monkeypatch.setattr(pieces, "FILTER_BITS", bits)
    path = public_tokenizers.path(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [prose(seed, 200) for seed in range(5)] + ["", "é 漢字 x"]
    assert [x.tolist() for x in pieces.Model(path).encode(texts)] == [library.encode(t) for t in texts]
