import random
import re

import numpy as np
import pytest
import xxhash

from riskloom.llm.common import components
from riskloom.llm.simhash import forest, links, near_duplicates, without_near_duplicates


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_roots(values, distance=2):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= distance:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def planted(seed, count):
    """Fingerprints with chains of near ones and one dense cluster."""
    rng = random.Random(seed)
    out = [0, 1, 3, 7, (1 << 64) - 1, 1 << 63]
    for _ in range(count):
        value = rng.getrandbits(64)
        out.append(value)
        for _ in range(rng.randrange(4)):
            value ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            out.append(value)
    base = rng.getrandbits(64)
    out += [base ^ rng.getrandbits(12) for _ in range(300)]
    return sorted(set(out), key=lambda v: hash((seed, v)))


@pytest.mark.parametrize("seed", [1, 2])
def test_links_lose_no_connection(spark, seed):
    values = planted(seed, 60)
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    found = components(links(spark.createDataFrame(rows, "node long, fp long"))).collect()
    got = list(range(len(values)))
    for r in found:
        got[r.node] = r.root
    assert got == brute_roots(values)


def test_forest_of_long_and_short_lists_agree():
    values = np.array(sorted({random.Random(5).getrandbits(64) & ~0xFFFF | x for x in range(0, 4000, 7)}), dtype=np.uint64)
    free = np.array([1 << b for b in range(16)], dtype=np.uint64)
    edges = forest(values, 2, free)
    assert len(edges) < len(values)
    roots = brute_roots([int(v) for v in values])
    parent = list(range(len(values)))
    for a, b in edges:
        assert roots[a] == roots[b]
        parent[max(a, b)] = min(a, b)
    assert len(edges) == len(values) - len(set(roots))


def test_components_of_chain_star_and_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(500, 500), (7, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{x: 100 for x in range(101, 160)}}


def test_edge_cases_against_brute_force(docs_of, edge_pairs):
    got = near_duplicates(docs_of(edge_pairs)).collect()
    prints = [brute_fingerprint(t) for _, t in edge_pairs]
    roots = brute_roots(prints)
    want = []
    for (i, _), value, root in zip(edge_pairs, prints, roots):
        ids = [x for (x, _), r in zip(edge_pairs, roots) if r == root and x is not None]
        want.append((str(i), f"{value:016x}", str(min(ids, default=None))))
    assert sorted((str(r.id), f"{r.fp % (1 << 64):016x}", str(r.best.id)) for r in got) == sorted(want)


def chained_pairs():
    """Texts whose fingerprints differ in one or two bits from the one before, in rising, falling and mixed order of ids."""
    rng = random.Random(11)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    chain, value = [" ".join(words)], brute_fingerprint(" ".join(words))
    while len(chain) < 4:
        other = list(words)
        other[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        new = brute_fingerprint(" ".join(other))
        if 1 <= bin(value ^ new).count("1") <= 2:
            words, value = other, new
            chain.append(" ".join(words))
    ids = [(1, 2, 3, 4), (14, 13, 12, 11), (22, 24, 21, 23)]
    return [[(i, f"{text} {g}" if g else text) for i, text in zip(order, chain)] for g, order in enumerate(ids)]


@pytest.mark.parametrize("which", [0, 1, 2])
def test_component_id_is_the_smallest_of_all_members(docs_of, which):
    """The row whose number is least (a component's root) counts, and gets its group's id."""
    pairs = chained_pairs()[which] + [(50, "something else entirely")]
    got = {r.id: r.best.id for r in near_duplicates(docs_of(pairs)).collect()}
    roots = brute_roots([brute_fingerprint(t) for _, t in pairs])
    assert got == {i: min(x for (x, _), r in zip(pairs, roots) if r == root) for (i, _), root in zip(pairs, roots)}
    assert len(set(got.values())) < len(pairs)


def test_stage_keeps_one_of_each_chain(docs_of):
    pairs = chained_pairs()[0]
    left = without_near_duplicates(docs_of(pairs)).select("doc_id").collect()
    assert [r.doc_id for r in left] == [1]


def test_stage_keeps_one_of_each_group(docs_of, edge_pairs):
    docs = docs_of(edge_pairs)
    out = without_near_duplicates(docs)
    assert out.columns == docs.columns
    assert out.count() == len(set(brute_roots([brute_fingerprint(t) for _, t in edge_pairs])))
    assert near_duplicates(docs_of([])).count() == 0
