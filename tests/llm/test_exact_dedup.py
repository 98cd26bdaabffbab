import hashlib
import re
from collections import defaultdict

from riskloom.llm.exact_dedup import exact_duplicates, without_exact_duplicates


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_edge_cases_against_brute_force(docs_of, edge_pairs):
    got = exact_duplicates(docs_of(edge_pairs)).collect()
    groups = defaultdict(list)
    for i, t in edge_pairs:
        groups[normal(t)].append(i)
    want = sorted(
        (str(i), str(min((x for x in groups[normal(t)] if x is not None), default=None)), len(groups[normal(t)]),
         hashlib.sha256(normal(t).encode()).hexdigest())
        for i, t in edge_pairs
    )
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    # Exactly one row of each group stays, repeated rows included.
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_stage_keeps_all_columns_and_one_row_a_group(docs_of, edge_pairs):
    docs = docs_of(edge_pairs)
    out = without_exact_duplicates(docs)
    assert out.columns == docs.columns
    assert out.count() == len({normal(t) for _, t in edge_pairs})


def test_empty_table(docs_of):
    assert exact_duplicates(docs_of([])).count() == 0


def test_group_of_a_third_of_all_rows(docs_of):
    pairs = [(i, "copy" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    rows = {r.doc_id: r for r in exact_duplicates(docs_of(pairs)).collect()}
    assert all(rows[i].keep_id == 0 and rows[i].group_size == 1000 for i in range(0, 3000, 3))
    assert rows[1].kept and rows[1].group_size == 1
