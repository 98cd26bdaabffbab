import hashlib
import random

import numpy as np
import pytest

from riskloom.llm import repeats
from riskloom.llm.repeats import united, without_repeats


def brute(pairs, length=100):
    texts = sorted({(i if i is not None else 1 << 62, t or "") for i, t in pairs}, key=lambda p: p[0])
    seen, out = set(), {}
    for key, text in texts:
        data = text.encode()
        covered = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                covered[p : p + length] = b"\1" * length
            else:
                seen.add(s)
        kept = bytes(c for c, f in zip(data, covered) if not f)
        spans = sum(1 for i in range(len(data)) if covered[i] and (i == 0 or not covered[i - 1]))
        out[key, text] = (len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return sorted((str(i), *out[i if i is not None else 1 << 62, t or ""]) for i, t in pairs)


def result(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [letters(n) for n in (99, 100, 101, 150, 333)]
    out = []
    for i in range(120):
        parts = [letters(rng.randrange(120))]
        for _ in range(rng.randrange(4)):
            parts += [rng.choice(shared), letters(rng.randrange(60))]
        out.append((i, "".join(parts)))
    # Slices of a shared text that start and end anywhere, periodic texts, copies, short and null texts.
    out += [(200 + i, letters(3) + shared[4][rng.randrange(200) :][: rng.randrange(95, 140)] + letters(3)) for i in range(60)]
    out += [(300, "ab" * 400), (301, "b" + "ab" * 70), (302, "a" * 99), (303, "a" * 100), (304, "a" * 1000), (305, None), (306, "")]
    out += [(307, out[5][1]), (None, out[9][1] + "tail"), (5, out[5][1]), (308, shared[1]), (309, shared[0] + "x")]
    return out


def test_against_brute_force(docs_of, pairs):
    assert result(without_repeats(docs_of(pairs))) == brute(pairs)


def test_hot_grams_and_pieces_change_nothing(docs_of, pairs, monkeypatch):
    hot = repeats.hot_grams

    def all_frequent(rows):
        grams = np.concatenate([np.unique(r["g"]) for r in repeats.anchor_runs(
            iter(rows.select("key", "h", "text").toArrow().to_batches()), np.zeros(0, np.uint64))])
        return np.unique(grams)[::2]

    assert len(hot(repeats.documents_of(docs_of(pairs), "doc_id", "text"))) == 0
    monkeypatch.setattr(repeats, "hot_grams", all_frequent)
    assert result(without_repeats(docs_of(pairs))) == brute(pairs)


def test_pieces_of_long_texts():
    rng = random.Random(2)
    data = bytes(rng.randrange(97, 101) for _ in range(6000))
    whole = repeats.anchors_of([(1, 1, 0, 0, len(data), data)], np.zeros(0, np.uint64))
    size, repeats.PIECE = repeats.PIECE, 700
    try:
        parts = repeats.anchors_of(list(repeats.pieces_of(1, 1, data)), np.zeros(0, np.uint64))
    finally:
        repeats.PIECE = size
    assert np.array_equal(np.sort(whole, order="pos"), np.sort(parts, order="pos"))


def test_united_spans():
    spans = np.array([(1, 0, 0, 5), (1, 0, 5, 9), (1, 0, 20, 30), (2, 0, 3, 4), (1, 0, 22, 25)], dtype=repeats.SPAN)
    assert united(spans).tolist() == [(1, 0, 0, 9), (1, 0, 20, 30), (2, 0, 3, 4)]


def test_empty_table(docs_of):
    assert without_repeats(docs_of([])).count() == 0
