"""Suffix-array dedup: removes every byte that a long string, found elsewhere too, covers.

A suffix array of every byte would be many times the corpus, so this one is sparse. Of the ``grams`` (32-byte strings)
inside each string of ``length`` bytes the one with the least hash, the leftmost of equals, is its anchor: equal
strings have their anchor at the same offset, so strings need comparing only with those of anchors with an equal gram.
An anchor's run is all starts that it is the anchor of, and its context the bytes that their strings cover.

1. Grams found once are left out. Contexts that occur twice, in any documents, are counted by an MD5 digest of their
   bytes and the anchor's place: all starts in their runs repeat. (The gram's digest, a rolling sum modulo 2^64, only
   finds candidates: a collision of it costs a comparison and decides nothing.)
2. Where a gram has several contexts, at least one of them single, the suffixes at those anchors are dealt
   by range, with splitters that Spark samples, on their leading bytes; each bucket is sorted by multikey quicksort,
   and neighbours give the length r that two suffixes share. What two contexts share before the anchor, l, comes from
   the order of the reversed bytes before it. A start o bytes before the anchor repeats if some other context has
   r >= length - o and l >= o: suffixes merge in the order of r, small groups into large, each keeping its order by l.
   Equal leading bytes are never split by a range boundary; a crowded gram is cut into block pairs, each compared.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.common import fresh_folder, fresh_name, needs, pair_blocks, stored

GRAM = 32
_PIECE = 1 << 22  # starts looked at together; positions in a piece fit 24 bits
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base, and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 18)
        _powers[:] = [np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, x, np.uint64)))) for x in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _powers


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def anchors(data: bytes, length: int = 400) -> tuple[np.ndarray, ...]:
    """(anchor, first start, last start, gram digest, and the two halves of the context digest) of each run, in order."""
    starts_in_all = len(data) - length + 1
    parts = [_piece(data[s : s + _PIECE + length - 1], length, s) for s in range(0, max(0, starts_in_all), _PIECE)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else tuple(np.zeros(0, np.int64) for _ in range(6))


def _piece(data: bytes, length: int, shift: int) -> tuple[np.ndarray, ...]:
    n = len(data)
    text, width = np.frombuffer(data, np.uint8), length - GRAM + 1
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[text] * power[:n], out=sums[1:])
    grams = _mixed((sums[GRAM:] - sums[: n - GRAM + 1]) * inverse[: n - GRAM + 1])
    value = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    padded = np.full(-(-len(value) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(value)] = value
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    least = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    at = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    lo = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    hi = np.append(lo[1:], starts) - 1
    anchor, end = at[lo], hi + length
    seal, view = hashlib.md5, memoryview(data)
    each = [seal(view[a:b], usedforsecurity=False).digest() for a, b in zip(lo.tolist(), end.tolist(), strict=True)]
    whole = np.frombuffer(b"".join(each), np.int64).reshape(-1, 2)
    return anchor + shift, lo + shift, hi + shift, grams[anchor].view(np.int64), whole[:, 0] + (anchor - lo), whole[:, 1]


def multikey_sort(strings: list[bytes], order: list[int] | None = None, depth: int = 0, word: int = 8) -> list[int]:
    """The numbers of the strings in order: three-way quicksort, a word of 8 bytes at a time."""
    done: list[int] = []
    stack = [(list(range(len(strings))) if order is None else order, depth, False)]
    while stack:
        part, d, ready = stack.pop()
        if ready or len(part) < 2:
            done += part
            continue
        if len(part) <= 16:
            done += sorted(part, key=lambda i: strings[i])
            continue
        keys = {i: strings[i][d : d + word] for i in part}
        pivot = sorted(keys[part[k * (len(part) - 1) // 8]] for k in range(9))[4]
        less, same, more = [], [], []
        for i in part:
            key = keys[i]
            (same if key == pivot else less if key < pivot else more).append(i)
        stack += [(more, d, False), (same, d + word, len(pivot) < word), (less, d, False)]
    return done


def shared_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, step = 0, 16
    while a[lo : lo + step] == b[lo : lo + step]:
        lo += step
        step = min(2 * step, 128)
    hi = min(lo + step, n)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def repeated_starts(before: list[bytes], after: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """(context, l, r) of contexts that share l bytes before and r after the anchor with another, l + r >= length.

    before: the bytes before each anchor, reversed; after: those from it on. For each context the yielded pairs cover
    every start that repeats: a pair of contexts that isn't yielded is inside one that is.
    """
    by_right = multikey_sort(after)
    left_rank = {i: k for k, i in enumerate(multikey_sort(before))}
    at_rank = {k: i for i, k in left_rank.items()}
    right = [shared_prefix(after[a], after[b]) for a, b in zip(by_right, by_right[1:], strict=False)]
    group = list(range(len(by_right)))
    members: list[list[int] | None] = [[left_rank[i]] for i in by_right]

    def find(k: int) -> int:
        while group[k] != k:
            group[k] = group[group[k]]
            k = group[k]
        return k

    longest = max(map(len, before), default=0)
    for k in sorted(range(len(right)), key=lambda k: -right[k]):
        r = right[k]
        if r + longest < length:
            break
        one, two = find(k), find(k + 1)
        if len(members[one]) < len(members[two]):
            one, two = two, one
        large, small = members[one], members[two]
        for rank in small:
            x, place = at_rank[rank], bisect.bisect_left(large, rank)
            for near in large[max(place - 1, 0) : place + 1]:
                y = at_rank[near]
                l = shared_prefix(before[x], before[y])  # noqa: E741
                if l + r >= length:
                    yield x, l, r
                    yield y, l, r
        if len(small) > 32:
            members[one] = sorted(large + small)
        else:
            for rank in small:
                bisect.insort(large, rank)
        members[two] = None
        group[two] = one


def _key(id_col: Column, text: Column) -> Column:
    return F.substring(F.unhex(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit("|"), F.md5(text)))), 1, 12)


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, block_rows: int = 32_768
) -> DataFrame:
    """docs with n_bytes, removed_spans and kept: what is left of each text's UTF-8 bytes without repeated strings.

    Every byte that a ``length``-byte string covers which also starts at another place, in the same document or in
    another, is removed; overlaps count and strings are judged on the input. removed_spans are the maximal removed
    runs (start, end) in bytes.

    Nulls: a null text is an empty one; a null id is as good as any. Texts shorter than ``length`` bytes lose nothing.
    Repeated rows: each is a document, so a text of ``length`` bytes or more that repeats is removed in all copies.
    Clashing column names: the new column gets a leading underscore. An empty table gives no rows.
    """
    needs(docs, id_col, text_col)
    if not GRAM < length <= 1 << 16:
        raise ValueError(f"length is over {GRAM} and at most 65536")
    spark = docs.sparkSession
    key = fresh_name(docs.columns, "_key")
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.withColumn(key, _key(F.col(id_col), text))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["key", "lo", "size", "off", "gram", "whole", "seal", "n"]
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in names]
            inside: list[tuple] = []
            for k, data in zip(batch["key"], batch["data"], strict=True):
                at, lo, hi, gram, whole, seal = anchors(bytes(data), length)
                if not len(at):
                    continue
                digest = np.stack([whole, seal], axis=1).view("S16").ravel()  # padded alike, so equal only if all bytes are
                _, first, which, n = np.unique(digest, return_index=True, return_inverse=True, return_counts=True)
                again = n[which] > 1
                begin = np.flatnonzero(again & np.concatenate(([True], ~again[:-1])))
                finish = np.flatnonzero(again & np.concatenate((~again[1:], [True])))
                inside += [(k, int(a), int(b - a)) for a, b in zip(lo[begin], hi[finish], strict=True)]
                for column, values in zip(out, (np.array([k] * len(first), dtype=object), *(x[first] for x in (lo, hi - lo, at - lo, gram, whole, seal)), n), strict=True):
                    column.append(values)
            if out[0]:
                yield pd.DataFrame({c: np.concatenate(x) for c, x in zip(names, out, strict=True)})
            if inside:
                yield pd.DataFrame(inside, columns=names[:3]).assign(off=0, gram=0, whole=0, seal=0, n=0)

    whole = base.select(F.col(key).alias("key"), text.cast("binary").alias("data")).filter(F.octet_length("data") >= length)
    where = fresh_folder(spark, "anchors")
    whole.mapInPandas(scan, "key binary, lo long, size int, off int, gram long, whole long, seal long, n int").write.parquet(where)
    runs = spark.read.parquet(where)
    starts = [F.col("key"), F.col("lo"), (F.col("lo") + F.col("size")).alias("hi")]

    differ = (F.min("whole") != F.max("whole")) | (F.min("seal") != F.max("seal"))
    grams = runs.filter("n > 0").groupBy("gram").agg(F.sum("n").alias("all"), differ.alias("mixed"))
    common = stored(grams.filter("all > 1").select("gram", "mixed"), "shared-grams")
    found = stored(runs.filter("n > 0").join(common, "gram"), "shared-anchors")

    context = ["gram", "whole", "seal"]
    mixed = found.filter("mixed")
    counted = stored(mixed.groupBy(*context).agg(F.sum("n").alias("all"), F.min(F.struct("key", "lo", "size", "off")).alias("at")), "contexts")
    repeated = runs.filter("n = 0").select(*starts).unionByName(found.filter("NOT mixed").select(*starts)).unionByName(
        mixed.join(counted.filter("all > 1").select(*context), context, "left_semi").select(*starts)
    )
    single = stored(counted.groupBy("gram").agg(F.min("all").alias("fewest")).filter("fewest = 1").select("gram"), "single-grams")
    one_each = counted.join(single, "gram", "left_semi").select("gram", F.col("all").alias("n"), "at.*")
    dealt = pair_blocks(one_each.withColumn("pick", F.struct("key", "lo")), ["gram"], "pick", block_rows).drop("pick", "block")
    wanted = stored(dealt.groupBy("key").agg(F.collect_list(F.struct("lo", "size", "off", "n", "block_i", "block_j")).alias("want")), "wanted")
    once = whole.join(wanted, "key").dropDuplicates(["key"])  # rows that repeat id and text have one key and are cut once

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, data, want in zip(batch["key"], batch["data"], batch["want"], strict=True):
                data = bytes(data)
                for w in want:
                    lo, a = w["lo"], w["lo"] + w["off"]
                    rows.append((k, a, w["n"], data[lo:a][::-1], data[a : lo + w["size"] + length], data[a : a + GRAM], w["block_i"], w["block_j"]))
            yield pd.DataFrame(rows, columns=["key", "anchor", "n", "before", "after", "lead", "block_i", "block_j"])

    contexts = once.mapInPandas(
        cut_out, "key binary, anchor long, n long, before binary, after binary, lead binary, block_i int, block_j int"
    )
    ranged = contexts.repartitionByRange("lead", "block_i", "block_j").sortWithinPartitions("lead", "block_i", "block_j")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []

        def solve() -> pd.DataFrame:
            rows = []
            if len(held) > 1:
                best: dict[int, set[tuple[int, int]]] = {}
                for i, l, r in repeated_starts([x[3] for x in held], [x[4] for x in held], length):  # noqa: E741
                    if held[i][2] == 1:
                        best.setdefault(i, set()).add((l, r))
                for i, pairs in best.items():
                    rows += [(held[i][0], held[i][1] - l, held[i][1] - length + r) for l, r in pairs]  # noqa: E741
            return pd.DataFrame(rows, columns=["key", "lo", "hi"])

        group = None
        for batch in batches:
            for r in batch.itertuples(index=False):
                this = (bytes(r.lead), r.block_i, r.block_j)
                if this != group:
                    if len(out := solve()):
                        yield out
                    held, group = [], this
                held.append((r.key, r.anchor, r.n, bytes(r.before), bytes(r.after)))
        if len(out := solve()):
            yield out

    compared = ranged.mapInPandas(compare, "key binary, lo long, hi long")
    spans = repeated.unionByName(compared).groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("starts"))
    names = {c: fresh_name(docs.columns, c) for c in ("n_bytes", "removed_spans", "kept")}

    def remove(data: pd.Series, starts: pd.Series) -> pd.DataFrame:
        rows = []
        for x, s in zip(data, starts, strict=True):
            x = bytes(x)
            merged: list[list[int]] = []
            for lo, hi in sorted((int(v["lo"]), int(v["hi"]) + length) for v in (s if s is not None else ())):
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], hi)
                else:
                    merged.append([lo, hi])
            ends = [0, *[e for _, e in merged]]
            kept = b"".join(x[a:b] for a, b in zip(ends, [*[s for s, _ in merged], len(x)], strict=True))
            rows.append((len(x), [{"start": a, "end": b} for a, b in merged], kept))
        return pd.DataFrame(rows, columns=["n_bytes", "removed_spans", "kept"])

    remove.__annotations__ = {"data": pd.Series, "starts": pd.Series, "return": pd.DataFrame}
    udf = F.pandas_udf(remove, "n_bytes long, removed_spans array<struct<start long, end long>>, kept binary")
    of_key, starts_at = fresh_name(base.columns, "_of_key"), fresh_name(base.columns, "_starts")
    joined = base.join(spans.withColumnsRenamed({"key": of_key, "starts": starts_at}), F.col(key) == F.col(of_key), "left")
    at = fresh_name(docs.columns, "_out")
    return joined.withColumn(at, udf(text.cast("binary"), F.col(starts_at))).select(
        *docs.columns, *[F.col(f"{at}.{c}").alias(n) for c, n in names.items()]
    )


def op5_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    spans = F.col("removed_spans")
    return suffix_dedup(docs).select(
        "doc_id", "n_bytes",
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
