"""What the run index searches, and that its matches stay exact."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from starflow.llm import suffix


def strings(rnd, count, width, letters):
    """Distinct rows of near copies: bytes plus one, zeros behind the end."""
    base = bytes(rnd.choices(letters, k=width))
    found = set()
    while len(found) < count:
        own = bytearray(base[: rnd.randint(20, width)])
        for _ in range(rnd.randint(0, 2)):
            own[rnd.randrange(len(own))] = rnd.choice(letters)
        found.add(bytes(own))
    rows = np.zeros((count, width), np.uint8)
    for k, own in enumerate(sorted(found)):
        rows[k, : len(own)] = np.frombuffer(own, np.uint8) + 1
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_run_index_equals_a_plain_search(seed):
    rnd = random.Random(seed)
    rows = strings(rnd, 40, 44, (b"ab", b"abcdefgh\xf4\x00")[seed % 2])
    owner = np.array([rnd.randrange(1000) for _ in rows])
    length = 20
    least = {}
    for own, who in zip(rows, owner, strict=True):
        size = int((own != 0).sum())
        for at in range(size - length + 1):
            part = own[at : at + length].tobytes()
            least[part] = min(least.get(part, who), who)
    got = suffix.RunIndex(rows, owner, length).least_documents(rows)
    for own, line in zip(rows, got, strict=True):
        size = int((own != 0).sum())
        want = [least[own[at : at + length].tobytes()] for at in range(size - length + 1)]
        assert line[: len(want)].tolist() == want
        assert (line[len(want) :] == suffix.NO_ID).all()


def test_patterns_search_only_when_they_leave_their_run(monkeypatch):
    rows = strings(random.Random(3), 40, 44, b"abcdefgh")
    index = suffix.RunIndex(rows, np.arange(40), 20)
    searched, plain = [], np.searchsorted
    monkeypatch.setattr(suffix.np, "searchsorted", lambda a, v, *x, **y: searched.append(len(v)) or plain(a, v, *x, **y))
    index.least_documents(rows)
    assert sum(searched) < (rows != 0).sum() / 2


def test_runs_are_found_in_small_pieces():
    rnd = random.Random(4)
    texts = ["".join(rnd.choices("abcdefgh ", k=8_000)) for _ in range(300)]
    table = pa.table({"doc_id": list(range(300)), "text": texts})
    tracemalloc.start()
    suffix.Runs(table, 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 14 * 300 * 8_000


@pytest.mark.parametrize("seed", range(4))
def test_runs_cover_every_window_once_and_stay_short(seed):
    rnd = random.Random(seed)
    texts = ["ab" * 300, "x" * 777, "", None, "".join(rnd.choices("ab", k=500)), "short"]
    rnd.shuffle(texts)
    runs = suffix.Runs(pa.table({"doc_id": list(range(6)), "text": pa.array(texts, pa.string())}), 50)
    assert runs.count.max() <= runs.width
    found = sorted(int(s) + k for s, c in zip(runs.start, runs.count, strict=True) for k in range(c))
    want = [int(runs.first[d]) + k for d, t in enumerate(texts) for k in range(len(t or "") - 49)]
    assert found == sorted(want)
    for s, d in zip(runs.start, runs.doc, strict=True):
        assert runs.first[d] <= s < runs.first[d] + runs.sizes[d]
