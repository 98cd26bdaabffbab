import hashlib
import random
import re

import pytest

from riskloom.llm import decontaminate
from riskloom.llm.decontaminate import build_index, document_hits, matches, without_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(pairs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item) if item is not None else "")
    out = []
    for key, text in pairs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((str(key), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    word = lambda: rng.choice(["the", "of", "a", "Étude", "x1", "omega", "rare%d" % rng.randrange(50)])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(30)]
    items += [(100, None), (101, "... !"), (None, "null item text"), (5, "null item text"), (102, "the the the the the the the the the the")]
    pairs = []
    for i in range(60):
        text = " ".join(word() for _ in range(rng.randrange(80)))
        if i % 3 == 0:
            text += "\n" + rng.choice(items)[1 if i else 1].__str__().upper() + ", " + word()
        pairs.append((i, text))
    pairs += [(7, None), (7, ""), (None, items[3][1]), (200, "the " * 400), (3, pairs[3][1])]
    return pairs, items


def test_against_brute_force(spark, docs_of, case):
    pairs, items = case
    items_df = spark.createDataFrame(items, "item_id long, text string")
    assert result(document_hits(docs_of(pairs), items_df)) == brute(pairs, items)


def test_blocks_shards_and_full_index_change_nothing(spark, docs_of, case, monkeypatch):
    pairs, items = case
    monkeypatch.setattr(decontaminate, "BLOCK", 7)
    monkeypatch.setattr(decontaminate, "MOST_TERMS", 3)
    items_df = spark.createDataFrame(items, "item_id long, text string")
    assert result(document_hits(docs_of(pairs), items_df)) == brute(pairs, items)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert result(document_hits(docs_of([(1, "a b")]), none)) == brute([(1, "a b")], [])
    assert document_hits(docs_of([]), none).count() == 0


def test_stage_drops_only_hit_rows(spark, docs_of, case):
    pairs, items = case
    docs = docs_of(pairs)
    out = without_contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert out.columns == docs.columns
    assert out.count() == sum(not r[-1] for r in brute(pairs, items))


def test_phrase_and_proximity_matches(spark, docs_of):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = docs_of([(1, "x alpha beta gamma y"), (2, "gamma x beta y alpha"), (3, "alpha " + "z " * 20 + "beta gamma"), (4, "alpha beta")])
    assert {(r.doc_id, r.position) for r in matches(docs, items).collect()} == {(1, 1)}
    assert {r.doc_id for r in matches(docs, items, span=5).collect()} == {1, 2}
    assert build_index(docs).count() >= 1
