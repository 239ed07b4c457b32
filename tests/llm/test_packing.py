import random
import string
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rasterloom.llm import packing as p

LIBRARY = Tokenizer.from_file(p.default_tokenizer())


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, docs, capacity):
    """docs: (id, text) rows; pieces hold every id once, sequences have no gap and no padding."""
    want = Counter((k, tuple(ids_of(t))) for k, t in docs)
    by_doc, by_sequence = {}, {}
    for r in pieces:
        assert r["length"] >= 1 and len(r["ids"]) == 4 * r["length"] and r["ids_crc32"] == zlib.crc32(r["ids"])
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    if len({k for k, _ in docs}) == len(docs):
        found = Counter()
        for k, rows in by_doc.items():
            rows.sort(key=lambda r: r["start"])
            ids = np.frombuffer(b"".join(r["ids"] for r in rows), "<u4").tolist()
            assert [r["start"] for r in rows] == np.cumsum([0] + [r["length"] for r in rows])[:-1].tolist()
            assert {r["doc_tokens"] for r in rows} == {len(ids)}
            found[k, tuple(ids)] += 1
        assert found == want
    assert sum(r["length"] for r in pieces) == sum(len(ids) * n for (_, ids), n in want.items())
    odd = []
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == np.cumsum([0] + [r["length"] for r in rows])[:-1].tolist()
        size = sum(r["length"] for r in rows)
        assert size <= capacity
        if size < capacity:
            odd.append(size)
    assert all(n & (n - 1) == 0 for n in odd) and len(set(odd)) == len(odd)
    assert set(by_sequence) == set(range(len(by_sequence)))


def test_ids_equal_the_library():
    codec, rng = p.WordIds(p.default_tokenizer(), 1), random.Random(3)
    assert codec.by_words and codec.width == 2
    for _ in range(4000):
        text = "".join(rng.choice("ab'sThe  \n\t\r\u0085  \u001ć가İΣσéÉ漢字🙂\u0000·1234.,!<|>") for _ in range(rng.randint(0, 40)))
        text = text.replace("|", "<|endoftext|>") if rng.random() < 0.2 else text
        assert np.frombuffer(codec.encode(text), "<u2").tolist() == ids_of(text), repr(text)
    for k in range(0x41, 0x300):  # every letter that takes the short way, and its neighbours
        for text in (f"ab{chr(k)}c", f"{chr(k)}.", f"{chr(k)}{chr(k ^ 1)}x,", f"x{chr(k)}'s!"):
            assert np.frombuffer(codec.encode(text), "<u2").tolist() == ids_of(text), repr(text)
    codec.by_words = False
    assert np.frombuffer(codec.encode("two words"), "<u2").tolist() == ids_of("two words")
    assert codec.encode(None) == codec.encode("") == b"\x01\x00"


def test_ends_of_words_do_not_send_them_to_the_library():
    codec, asked = p.WordIds(p.default_tokenizer(), 1), []
    library = codec.library

    class Counted:
        def encode(self, text, **how):
            asked.append(text)
            return library.encode(text, **how)

    codec.library = Counted()
    tails = [*string.punctuation, "***", ".&&&", "',", "'", "''\"", "|>", "<|", ")).", "$$$%", "'!'"]
    for tail in tails:
        for word in ("osbo", "Asieezdo", "ciónré", "s", "x's", "don't"):
            assert np.frombuffer(codec.encode(f"{word}{tail} {word}"), "<u2").tolist() == ids_of(f"{word}{tail} {word}"), word + tail
    assert not any(x[0] in "oAc" for x in asked)


def slow_best(prices, sizes, capacity):
    best = [0.0] * (capacity + 1)
    for room in range(1, capacity + 1):
        best[room] = max([best[room - 1]] + [v + best[room - s] for v, s in zip(prices, sizes, strict=True) if s <= room])
    return best[capacity]


@pytest.mark.parametrize("seed", range(8))
def test_plan_meets_demand_with_few_sequences(seed):
    rng = np.random.default_rng(seed)
    sizes = np.sort(rng.choice(np.arange(1, 65), rng.integers(1, 65), replace=False))
    demand = rng.integers(1, 200, len(sizes)).astype(float)
    prices = rng.random(len(sizes)) - 0.2
    worth, pattern = p.best_pattern(prices, sizes, 64)
    assert worth == pytest.approx(slow_best(prices, sizes, 64)) == pytest.approx(float(pattern @ prices)) and pattern @ sizes <= 64
    patterns, used = p.cutting_stock(sizes, demand, 64)
    assert (patterns @ sizes <= 64).all() and (used @ patterns >= demand - 1e-6).all()
    #: The least number of sequences lies between the sum of sizes and first fit, longest first.
    bins = []
    for s in sorted(np.repeat(sizes, demand.astype(int)).tolist(), reverse=True):
        k = next((k for k, room in enumerate(bins) if room >= s), None)
        if k is None:
            bins.append(64 - s)
        else:
            bins[k] -= s
    assert float(sizes @ demand) / 64 - 1e-6 <= used.sum() <= len(bins) + 0.1


@pytest.mark.parametrize("long", [0, 3, 5000, 10**7])
def test_plan_never_leaves_more_gaps_than_the_line_holds(long):
    rng = np.random.default_rng(long)
    histogram = {int(n): int(c) for n, c in zip(rng.choice(np.arange(1, 2049), 700, replace=False), rng.integers(1, 50, 700), strict=True)}
    made = p.plan(histogram, long, 2048)
    assert 0 <= made.gaps <= made.line and made.line + made.sequences * 2048 - made.gaps == long + sum(n * c for n, c in histogram.items())
    for c, covered in made.covered.items():
        sequence, _ = made.places(np.full(covered + 2, c), np.arange(covered + 2))
        assert (sequence[:covered] >= 0).all() and (sequence[covered:] == -1).all() and (sequence < made.sequences).all()
    assert sum(made.covered.values()) > 0.9 * sum(histogram.values()) or long < 5000


@pytest.mark.parametrize("capacity", [2048, 64, 1])
def test_rows(docs_of, capacity):
    rng = random.Random(capacity)
    words = ["sun", "moon", "river", "naïve", "漢字", "of", "the", "x9"]
    docs = [(k, " ".join(rng.choice(words) for _ in range(int(rng.paretovariate(0.7)) + 3))[:30_000]) for k in range(150)]
    docs += [(200, None), (201, ""), (202, "word " * 9000), (203, "y" * 20_000), (None, "no id")]
    check([r.asDict() for r in p.pack(docs_of(docs, "ids start key id_"), capacity=capacity).collect()], docs, capacity)


def test_repeats_one_row_and_no_rows(docs_of):
    docs = [(7, "same text here")] * 400 + [(8, "other")]
    out = [r.asDict() for r in p.pack(docs_of(docs), capacity=16).collect()]
    check(out, docs, 16)
    check([r.asDict() for r in p.pack(docs_of([(1, None)])).collect()], [(1, None)], 2048)
    assert p.pack(docs_of([])).collect() == []
    with pytest.raises(ValueError):
        p.pack(docs_of([]), capacity=1000)


def test_query(spark, tmp_path, docs_of):
    docs = [(k, "some words " * (k * 17 % 90)) for k in range(60)]
    docs_of(docs).withColumn("length", F.lit("mine")).write.parquet(f"{tmp_path}/documents.parquet")
    got = p.op11_query(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = {k: np.array(ids_of(t), "<u4") for k, t in docs}
    assert all(r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) for r in got.collect())
