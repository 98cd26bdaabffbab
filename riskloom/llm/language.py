"""Language of whole texts by cross-parsing against labelled text.

For each language a bounded sample of its labelled text is kept, and a suffix automaton of the sample answers for any place of a text
how far the longest match with the sample reaches. A text is cut greedily into such longest matches; the language that needs the
fewest phrases wins, where a phrase counts as many bits as it takes to name a place in that language's sample (so a
larger sample is no advantage).

Texts are compared as the UTF-8 bytes of their lower-cased runs of letters, with one space around each. They are parsed in segments that end
with the first word past SEGMENT bytes, many side by side: all languages and segments of a slice of rows take one step of
their automata at a time. The samples travel (SAMPLE code points a language, at most LANGUAGES of them);
each Python worker builds the automata once. Parsing is one pass without a shuffle, linear in the text.

Defined cases: a null text and one without a letter are ``und`` with score 0, and so is everything when no language could be
learnt. Equal phrase costs go to the language first in the alphabet. Rows with a null key are predicted, but never learnt from. Every row
gives one row, repeated ones too; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import over_slices, quoted

#: Bound on the labelled code points kept for each language, and on the languages (the most frequent ones are learnt).
SAMPLE = 50_000
LANGUAGES = 256
#: Labelled texts are sampled in pieces of about so many code points, chosen by a hash of text and place.
PIECE = 200
#: Bytes after which a segment of a text ends with its word.
SEGMENT = 240
#: Ends a piece inside a sample; it is neither letter nor space, so no match runs across.
BREAK = "\n"
UNKNOWN = "und"
GRAIN = 1 << 32

Samples = tuple[tuple[str, str], ...]

_WORDS = re.compile(r"[^\W\d_]+")


def held_out(key: Column) -> Column:
    """Whether a row must not be learnt from: crc32 of the key as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def plain(text: str | None) -> str:
    """Lower-cased words with a space before, between and after; empty without a letter."""
    words = _WORDS.findall(text.lower()) if text else ()
    return f" {' '.join(words)} " if words else ""


def automaton(text: bytes) -> list[dict[int, int]]:
    """The suffix automaton of ``text``: next states by byte; what can be read from state 0 are the substrings."""
    after: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        state = len(after)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in after[at]:
            after[at][c] = state
            at = link[at]
        if at >= 0:
            long = after[at][c]
            if length[long] == length[at] + 1:
                link[state] = long
            else:
                short = len(after)
                after.append(dict(after[long]))
                length.append(length[at] + 1)
                link.append(link[long])
                while at >= 0 and after[at].get(c) == long:
                    after[at][c] = short
                    at = link[at]
                link[long] = link[state] = short
        last = state
    return after


@dataclass
class Model:
    """The automata of all languages in one table. Entry (state, letter) is 4 * next state + phrases ended by this step, where
    a state is the place of its row. ``letters`` gives each byte's column: the first is the end of a segment, the
    second stands for all bytes that no sample holds."""

    languages: list[str]
    bits: np.ndarray
    letters: np.ndarray
    roots: np.ndarray
    table: np.ndarray

    def phrases(self, segments: list[bytes]) -> np.ndarray:
        """Greedy phrases by language and segment: each the longest match from its place, or one unseen byte."""
        lengths = np.array([len(s) for s in segments])
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        codes = self.letters[np.frombuffer(b"".join(segments), np.uint8)]
        # How many segments, longest first, have a byte at each step.
        active = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), "left")
        state = np.repeat(self.roots[:, None], len(segments), 1)
        count = np.zeros(state.shape, np.int32)
        for step, m in enumerate(active.tolist()):
            found = self.table[state[:, :m] + codes[starts[:m] + step]]
            count[:, :m] += found & 3
            state[:, :m] = found >> 2
        count += self.table[state] & 3
        out = np.empty_like(count)
        out[:, order] = count
        return out

    def decided(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, share of belief) of each text: its code lengths in bits are taken as negative logarithms of belief."""
        segments, owners = [], []
        for place, text in enumerate(texts):
            for segment in cut(plain(text).encode(), SEGMENT):
                segments.append(segment)
                owners.append(place)
        out = [(UNKNOWN, 0.0)] * len(texts)
        if segments and self.languages:
            totals = np.zeros((len(texts), len(self.languages)))
            np.add.at(totals, owners, self.phrases(segments).T)
            for place in sorted(set(owners)):
                bits = totals[place] * self.bits
                best = int(bits.argmin())
                out[place] = self.languages[best], float(1.0 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum())
        return out


@functools.lru_cache(maxsize=2)
def model_of(samples: Samples) -> Model:
    """Kept by the worker for its next tasks."""
    texts = [text.encode() for _, text in samples]
    used = sorted(set().union(*texts))
    letters = np.ones(256, np.int32)
    letters[used] = np.arange(2, 2 + len(used))
    width = 2 + len(used)
    tables, roots, first = [], [], 0
    for text in texts:
        after = automaton(text)
        states = np.full((len(after), width), -1, np.int64)
        for place, edges in enumerate(after):
            states[place, letters[list(edges)]] = list(edges.values())
        # Where no match goes on, a phrase ends (none does at the start) and the byte begins the next one.
        going = states >= 0
        ended = (np.arange(len(after)) > 0).astype(np.int64)[:, None]
        again = np.where(going[0], states[0], 0)
        # A byte that begins no match either is a phrase by itself; the end of a segment is none.
        alone = ~going[0]
        alone[0] = False
        step = np.where(going, 4 * (first + states * width), 4 * (first + again * width) + ended + alone)
        tables.append(step.astype(np.int32).ravel())
        roots.append(first)
        first += step.size
    if 4 * first >= 1 << 31:
        raise ValueError(f"{len(texts)} samples of {max(map(len, texts))} bytes are too much for one table; lower sample or languages")
    table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
    return Model([name for name, _ in samples], np.array([math.log2(len(t) + 1) for t in texts]), letters, np.array(roots, np.int32), table)


def cut(letters: bytes | str, size: int) -> list:
    """Cut after the first word end past each ``size``."""
    space, out, start = " " if isinstance(letters, str) else b" ", [], 0
    while start < len(letters):
        stop = letters.find(space, start + size)
        stop = len(letters) if stop < 0 else stop + 1
        out.append(letters[start:stop])
        start = stop
    return out


def fit_languages(df: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang", sample: int = SAMPLE,
                  languages: int = LANGUAGES) -> Samples:
    """The samples of the labelled rows that are not held out.

    Pieces are chosen by hash, with a share that makes ``sample`` code points of each language expected; equal pieces are kept once, so
    copies of one text cannot fill a sample.
    """
    learnt = df.where(quoted(language).isNotNull() & quoted(key).isNotNull() & ~held_out(quoted(key)))
    learnt = learnt.select(quoted(language).cast("string").alias("language"), quoted(text).alias("text"))
    sizes = learnt.groupBy("language").agg(F.sum(F.length("text")).alias("size")).where("size > 0")
    share = {r["language"]: min(1.0, sample / r["size"]) for r in sizes.orderBy(F.desc("size"), "language").limit(languages).collect()}
    if not share:
        return ()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, texts = [], []
        for name, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name not in share or not whole:
                continue
            limit = int(share[name] * GRAIN)
            parts = cut(plain(whole), PIECE)
            # One digest seeds the draws of all pieces of a text.
            draws = np.random.default_rng(int.from_bytes(hashlib.md5(whole.encode("utf-8", "replace")).digest(), "little")).integers(0, GRAIN, len(parts))
            for place in np.flatnonzero(draws < limit).tolist():
                names.append(name)
                texts.append(parts[place])
        return pa.RecordBatch.from_pydict({"language": pa.array(names, pa.string()), "piece": pa.array(texts, pa.string())})

    chosen = learnt.mapInArrow(lambda batches: over_slices(batches, work), "language string, piece string").distinct()
    gathered: dict[str, list[str]] = {}
    for row in chosen.collect():  # about ``sample`` code points a language
        gathered.setdefault(row["language"], []).append(row["piece"])
    return tuple((name, BREAK.join(sorted(gathered[name]))) for name in sorted(gathered))


RESULT = "held_out boolean, lang_pred string, score double"


def predict_language(df: DataFrame, samples: Samples, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``df``: the key, held_out, lang_pred, score."""
    rows = df.select(quoted(key).alias("key"), held_out(quoted(key)).alias("held_out"), quoted(text).alias("text"))
    sent = df.sparkSession.sparkContext.broadcast(samples)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = model_of(sent.value).decided(batch.column(2).to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=["key", "held_out", "lang_pred", "score"],
        )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: over_slices(batches, work), f"key {kind}, {RESULT}").withColumnRenamed("key", key)
