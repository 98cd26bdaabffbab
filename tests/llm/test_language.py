import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskloom.llm.language import BREAK, SEGMENT, automaton, cut, fit_languages, held_out, model_of, plain, predict_language


def plain_phrases(sample, text):
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at, count = at + size, count + 1
    return count


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcé ", max_size=40), min_size=1, max_size=3), st.lists(st.text("abcdé ", max_size=60), max_size=5))
def test_phrases_equal_plain_longest_matches(samples, texts):
    found = model_of(tuple((str(k), s) for k, s in enumerate(samples))).phrases([t.encode() for t in texts])
    assert found.tolist() == [[plain_phrases(s.encode(), t.encode()) for t in texts] for s in samples]


@settings(max_examples=50, deadline=None)
@given(st.text("ab", max_size=14))
def test_automaton_reads_exactly_the_substrings(text):
    after = automaton(text.encode())
    words, waiting = set(), [("", 0)]
    while waiting:
        word, node = waiting.pop()
        words.add(word)
        waiting += [(word + chr(c), to) for c, to in after[node].items()]
    assert words == {text[i:j] for i in range(len(text) + 1) for j in range(i, len(text) + 1)}


def test_decision_equals_brute_force():
    samples = (("x", "the cat sat on the mat" + BREAK + "that hat"), ("y", "le chat est sur la table"))
    texts = ["The cat", "chat 12 sur la TABLE", "zzz", "é", "x", "the mat " * 200, None, "12 - _ 3", ""]
    for text, (language, score) in zip(texts, model_of(samples).decided(texts)):
        parts = cut(plain(text).encode(), SEGMENT)
        if not parts:
            assert (language, score) == ("und", 0.0)
            continue
        cost = [sum(plain_phrases(s.encode(), t) for t in parts) * np.log2(len(s.encode()) + 1) for _, s in samples]
        assert language == "xy"[int(np.argmin(cost))] and score == pytest.approx(1 / sum(2 ** max(min(cost) - c, -1000) for c in cost))
    assert model_of(()).decided(["text", None]) == [("und", 0.0)] * 2


def test_cuts_keep_every_letter():
    text = "Ab cd, " * 500 + "x" * 1000 + " end"
    assert "".join(cut(plain(text), 200)) == plain(text) and len(cut(plain(text), 200)) > 8
    assert cut(plain(None), 200) == cut(plain("12").encode(), 200) == []


def test_query_on_held_out_rows(spark):
    tables = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    found = entry.queries()["op12_language"](spark, tables)
    rows = found.join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert all((r.lang_pred == "und") == (plain(r.text) == "") for r in rows)
    judged = [r for r in rows if r.held_out and r.lang is not None and r.lang_pred != "und"]
    assert np.mean([r.lang == r.lang_pred for r in judged]) > 0.97


def test_edges(spark, docs_of, edge_pairs):
    docs = docs_of(edge_pairs)
    rows = predict_language(docs, fit_languages(docs)).collect()
    assert len(rows) == len(edge_pairs)
    assert all(r.lang_pred == ("und" if not plain(dict_text) else "en") for r, dict_text in zip(rows, [t for _, t in edge_pairs]))
    assert predict_language(docs_of([]), fit_languages(docs_of([]))).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in predict_language(unlabelled, fit_languages(unlabelled)).collect()} == {("und", 0.0)}


def test_held_out_rows_and_copies_do_not_fill_the_sample(spark):
    rows = [(i, f"held out text {i}" if zlib.crc32(str(i).encode()) % 3 == 1 else "copy of one text", "en") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert fit_languages(df) == (("en", " copy of one text "),)
    assert df.where(held_out(F.col("doc_id"))).count() == sum(t.startswith("held") for _, t, _ in rows)
