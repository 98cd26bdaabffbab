import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from riskloom.llm import ranked
from riskloom.llm.ranked import build_index, count_terms, search, terms_of
from riskloom.llm.treap import best_columns, build


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, count):
    """Rows of (item, rank, key, score) by the formulas alone."""
    found = [(k, Counter(plain_terms(t))) for k, t in docs]
    found = [(k, c) for k, c in found if c]
    big_n, big_l = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c in found:
            m = 75 + 25 * sum(c.values()) * big_n // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t in plain_terms(text) if c[t])
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, r + 1, key, -s) for r, (s, _, _, key) in enumerate(sorted(scores)[:count])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_terms():
    for text in ("A b-C_d É1 x y", "\x00a\x7fb", "", None, "ÀÉ zz9"):
        assert [t.decode() for t in terms_of(text)] == plain_terms(text)


@pytest.mark.parametrize("density", [0.03, 0.3, 0.9])
def test_best_columns_equal_brute_force(density):
    rng = np.random.default_rng(int(density * 100))
    for _ in range(60):
        shape = rng.integers(1, 60), rng.integers(1, 90)
        grid = rng.integers(1, 5, shape) * (rng.random(shape) < density)
        rows, columns = np.nonzero(grid)
        tree = build(rows, columns, grid[rows, columns].astype(np.int32))
        asked = rng.choice(shape[0], min(shape[0], 6), replace=False).astype(np.int64)
        weights = rng.integers(0, 3, len(asked)).astype(np.int64)
        scores = (grid[asked] * weights[:, None]).sum(0)
        wanted = sorted((-int(s), c) for c, s in enumerate(scores) if s > 0)
        assert best_columns(tree, asked, weights, 5) == [(-s, c) for s, c in wanted[:5]]
        assert best_columns(tree, asked, weights, 5, 4) == [(-s, c) for s, c in wanted[:5] if -s >= 4]


def test_edges_in_small_shards(spark, docs_of, edge_pairs, monkeypatch):
    docs = docs_of(edge_pairs)
    items = [(1, "same text TEXT"), (2, None), (3, ""), (4, "nowhere"), (5, "one é two word7 word7"), (5, "text"), (None, "text")]
    asked = spark.createDataFrame([(i, t, 1, 1, 1) for i, t in items], "item_id long, text string, rank int, score int, place int")
    for cells, block in ((ranked.CELLS, ranked.BLOCK), (3, 2)):
        monkeypatch.setattr(ranked, "CELLS", cells)
        monkeypatch.setattr(ranked, "BLOCK", block)
        assert rows_of(search(build_index(docs), asked, 4)) == brute(edge_pairs, items, 4)
    assert search(build_index(docs_of([])), asked).count() == 0
    assert search(build_index(docs), asked.limit(0)).count() == 0
    totals = count_terms(docs, "text")
    sizes = [len(plain_terms(t)) for _, t in edge_pairs]
    assert (totals.documents, totals.terms) == (sum(n > 0 for n in sizes), sum(sizes))


def test_query_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert rows_of(entry.queries()["op13_ranked_search"](spark, sf)) == brute(docs, items, 20)


def test_shards_are_written_and_read_few_at_a_time(spark):
    """A task's memory holds some shards, not all that its file has, and its worker gets no more than some megabytes at once."""
    rows = 3 * ranked.COLUMNS + 1
    index = ranked.build_index(spark.range(0, rows, 1, 1).selectExpr("id AS doc_id", "concat('w', id % 1000) AS text"))
    groups = [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata for f in index.shards.inputFiles()]
    sizes = [g.row_group(i).num_rows for g in groups for i in range(g.num_row_groups)]
    assert sum(sizes) == 4 and max(sizes) <= ranked.TOGETHER
    long = spark.range(0, 300, 1, 1).selectExpr("repeat('a', 100000) AS text")
    most = long.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").agg({"n": "max"}).first()[0]
    assert most < 20e6
