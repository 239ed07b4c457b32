"""SimHash near-dedup: 64-bit fingerprints linked by a binary-trie self-join with a Hamming error budget."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import components, cut, fresh_name, let_go, needs, pair_blocks, runs_of, stored

SEED = 42
BITS = 64
#: Of the long SimHash that finds candidates by similarity: fields, their bits, and how many of 128 bits may differ, twice
#: as many of 256.
FIELDS, WIDTH, NEAR = 64, 14, 40
CODES = ["f1", "f2", "f3", "f4"]  # the first 256 bits
FIRST_FIELDS = 40  # the fields that the first comparisons are taken from
#: Pairs compared at once, and texts in a batch, which bound a Python worker's memory.
CHUNK, BATCH = 100_000, 500
PIVOTS = 64  # rows of a bucket of over as many that meet the others at once
#: What rows of one bucket share: a field's value and a pair of blocks.
BUCKET = ["key", "block_i", "block_j"]
#: What texts that are compared at once share, and about how many of a cluster are in a block.
CLUSTER, TEXTS = ["cluster", "block_i", "block_j"], 512


def fingerprint(text: str | None, words: int = 4) -> int:
    """The SimHash of a text's word shingles as a signed 64-bit integer; 0 without words."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        starts = np.concatenate(([0], ends[:-words])).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)]
    each = np.array(hashes, np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(each), 1 << 16):
        part = each[at : at + (1 << 16)]
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(each))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(text: Column, words: int = 4) -> Column:
    """The 64-bit fingerprint column of a text column."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, words) for x in texts], dtype="int64")

    return of(text)


def _expand(lo_a, n_a, lo_b, n_b):
    """Every (a, b) of the ranges lo_a..+n_a and lo_b..+n_b, range pair by range pair."""
    each = n_a * n_b
    start = np.repeat(np.cumsum(each) - each, each)
    k = np.arange(each.sum(), dtype=np.int64) - start
    width = np.repeat(n_b, each)
    return np.repeat(lo_a, each) + k // width, np.repeat(lo_b, each) + k % width


def trie_pairs(codes: np.ndarray, ranges: np.ndarray, budget: int, leaf: int = 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of codes that differ in at most ``budget`` bits, walking pairs of trie nodes together.

    codes: unsigned; ``ranges``: rows (lo_a, hi_a, lo_b, hi_b) of sorted runs to compare, a run with itself or with
    another. A trie node is a range of a sorted run. Both nodes of a pair go down a bit at a time; going apart costs
    one error, and a pair whose errors exceed the budget is pruned. Pairs of small nodes are compared directly.
    """
    lo_a, hi_a, lo_b, hi_b = (np.ascontiguousarray(ranges[:, k], dtype=np.int64) for k in range(4))
    errors = np.zeros(len(lo_a), np.int8)
    for bit in range(BITS - 1, -2, -1):
        small = ((hi_a - lo_a) * (hi_b - lo_b) <= leaf * leaf) | (bit < 0)
        if small.any():
            for at in np.array_split(np.flatnonzero(small), 1 + int(((hi_a - lo_a) * (hi_b - lo_b))[small].sum()) // 4_000_000):
                a, b = _expand(lo_a[at], (hi_a - lo_a)[at], lo_b[at], (hi_b - lo_b)[at])
                near = (a != b) & (np.bitwise_count(codes[a] ^ codes[b]) <= budget)
                same = np.repeat(lo_a[at] == lo_b[at], ((hi_a - lo_a) * (hi_b - lo_b))[at])
                near &= ~same | (a < b)
                yield a[near], b[near]
        keep = ~small
        lo_a, hi_a, lo_b, hi_b, errors = lo_a[keep], hi_a[keep], lo_b[keep], hi_b[keep], errors[keep]
        if not len(lo_a):
            return
        ones = np.concatenate(([0], np.cumsum((codes >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)))
        mid_a, mid_b = hi_a - (ones[hi_a] - ones[lo_a]), hi_b - (ones[hi_b] - ones[lo_b])
        self_pair = (lo_a == lo_b) & (hi_a == hi_b)
        parts = [
            (lo_a, mid_a, lo_b, mid_b, errors, None),
            (mid_a, hi_a, mid_b, hi_b, errors, None),
            (lo_a, mid_a, mid_b, hi_b, errors + 1, None),
            (mid_a, hi_a, lo_b, mid_b, errors + 1, ~self_pair),
        ]
        out = []
        for p, q, r, s, e, only in parts:
            ok = (q > p) & (s > r) & (e <= budget)
            ok &= only if only is not None else True
            out.append((p[ok], q[ok], r[ok], s[ok], e[ok].astype(np.int8)))
        lo_a, hi_a, lo_b, hi_b, errors = (np.concatenate(x) for x in zip(*out, strict=True))


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index of each of n nodes' component under the pairs (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        live = root[a] != root[b]
        a, b = a[live], b[live]
        if np.array_equal(before, root) and not live.any():
            break
    return root


def bands(bits: int, parts: int) -> list[tuple[int, int]]:
    """(shift, width) of ``parts`` near-equal bit fields."""
    cuts = [bits * k // parts for k in range(parts + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def hamming_links(codes: DataFrame, budget: int = 4, block_rows: int = 4096) -> DataFrame:
    """Links (a, b) that connect all codes(fp) within ``budget`` differing bits, as a spanning set of each bucket.

    budget + 1 bit fields: two codes within the budget agree on one whole field, so the trie is cut below its roots
    by (field, value) and each part is joined with itself in one task. Hot parts go through pair_blocks.
    """
    fields = F.array(*[
        F.struct(F.lit(k).alias("field"), F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1).cast("long")).cast("int").alias("value"))
        for k, (s, w) in enumerate(bands(BITS, budget + 1))
    ])
    parts = codes.select("fp", F.explode(fields).alias("x")).select("fp", "x.field", "x.value")
    dealt = pair_blocks(parts, ["field", "value"], "fp", block_rows)

    key_names = ["field", "value", "block_i", "block_j"]

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in runs_of(batches, key_names, 50_000):
            fp, key = rows.fp.to_numpy().view(np.uint64), rows[[*key_names, "block"]].to_numpy()
            order = np.lexsort((fp, *key.T[::-1]))
            fp, key = fp[order], key[order]
            run = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
            end = np.append(run[1:], len(fp))
            inner = key[run, 2] == key[run, 3]
            ranges = [np.stack([run, end, run, end], 1)[inner & (end - run > 1)]]
            cross = np.flatnonzero(~inner[:-1] & (key[run[:-1], :4] == key[run[1:], :4]).all(axis=1)) if len(run) > 1 else np.array([], int)
            ranges.append(np.stack([run[cross], end[cross], run[cross + 1], end[cross + 1]], 1))
            ranges = np.concatenate(ranges)
            if not len(ranges):
                continue
            values, back = np.unique(fp, return_inverse=True)
            root = np.arange(len(values))
            for a, b in trie_pairs(fp, ranges, budget):  # folded in as they come: a task holds roots, not pairs
                if len(a):
                    root = spanning(root[back[a]], root[back[b]], len(values))[root]
            linked = np.flatnonzero(root != np.arange(len(values)))
            if len(linked):
                yield pd.DataFrame({"a": values[linked].view(np.int64), "b": values[root[linked]].view(np.int64)})

    shuffled = dealt.repartition(*key_names).sortWithinPartitions(*key_names)
    return shuffled.select(*key_names, "block", "fp").mapInPandas(join, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 4, words: int = 4) -> DataFrame:
    """One row per row of docs: its id, fingerprint (16 hex digits) and component_id.

    Texts are lower-cased (A-Z), cut into words at ASCII white space and into shingles of ``words``, repeats included;
    each bit of the fingerprint is the majority of the shingles' XXH64 hashes. Fingerprints that differ in at most
    ``budget`` bits are linked; component_id is the smallest id that the links reach.

    Nulls: a null text is an empty one (fingerprint zero, linked like any other); rows with a null id get the
    component of their fingerprint, and null where no row of it has an id. Repeated rows: each is returned. An empty
    table gives no rows. Other columns are not read.
    """
    needs(docs, id_col, text_col)
    of = cut(docs.select(F.col(id_col).alias("id"), fingerprints(F.col(text_col), words).alias("fp")))
    distinct = of.groupBy("fp").agg(F.min("id").alias("low"))
    roots = components(hamming_links(distinct.select("fp"), budget)).withColumnRenamed("node", "fp")
    linked = stored(distinct.join(roots, "fp").select("fp", "low", "root"), "linked")
    low = stored(linked.groupBy("root").agg(F.min("low").alias("component_id")), "lowest-ids")
    known = linked.join(low, "root").select("fp", "component_id")
    alone = distinct.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("low").alias("component_id"))
    return of.join(stored(alone.unionByName(known), "classes"), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _firsts(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs whose id is their component_id in found, each once, and those with a null id."""
    kept_id = fresh_name(docs.columns, "kept_id")
    keep = found.filter(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias(kept_id)).distinct()
    known = docs.filter(F.col(id_col).isNotNull()).join(keep, F.col(id_col) == F.col(kept_id), "left_semi")
    rank = fresh_name(docs.columns, "rank_in_id")
    first = Window.partitionBy(id_col).orderBy(F.xxhash64(text_col), text_col)
    once = known.withColumn(rank, F.row_number().over(first)).filter(F.col(rank) == 1).drop(rank)
    return once.unionByName(docs.filter(F.col(id_col).isNull()))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 4, words: int = 4) -> DataFrame:
    """docs without near copies: of each component the row with the smallest id stays.

    Rows that repeat the smallest id keep the one whose text sorts first, once. Rows with a null id stay, as nothing
    tells them apart. Columns are those of docs.
    """
    return _firsts(docs, simhash_groups(docs.select(id_col, text_col), id_col, text_col, budget, words), id_col, text_col)


def _parts(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str | None, words: int = 5) -> set[bytes]:
    """The different runs of ``words`` words of a text; the whole text where it has fewer."""
    parts = _parts(text)
    line = b" ".join(parts)
    if len(parts) <= words:
        return {line}
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-words])).tolist()
    return {line[s:e] for s, e in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)}


def similar(a: set[bytes], b: set[bytes], least: float) -> bool:
    """Whether two sets have a Jaccard similarity of ``least`` or more."""
    both = len(a & b)
    return both + 1e-9 >= least * (len(a) + len(b) - both)


def _hashes(text: str | None, words: int) -> np.ndarray:
    """The different hashes of a text's shingles, in order."""
    parts, digest = _parts(text), xxhash.xxh64_intdigest
    line = b" ".join(parts)
    if len(parts) <= words:
        return np.array([digest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-words])).tolist()
    return np.unique(np.array([digest(line[s:e], SEED) for s, e in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)], np.uint64))


def _sketch(base: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The keys of the fields of the long SimHash of shingles' hashes, and its first 256 bits as CODES."""
    ones = np.zeros(FIELDS * WIDTH, np.int64)
    for at in range(0, len(base), 255):  # as many as a byte can count
        x = base[at : at + 255, None] + np.arange(1, FIELDS * WIDTH // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        ones += np.add.reduce(np.unpackbits(x.view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    bits = 2 * ones > len(base)
    fields = bits.reshape(FIELDS, WIDTH) @ (1 << np.arange(WIDTH)) + (np.arange(FIELDS) << WIDTH)
    return fields.astype(np.int32), np.packbits(bits[:256]).view(np.int64).tolist()


def sketch(found: set[bytes]) -> tuple[np.ndarray, int, int]:
    """The keys of a long SimHash's FIELDS fields of WIDTH bits, and its first 128 bits as two signed integers."""
    fields, codes = _sketch(np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in found), np.uint64, len(found)))
    return fields, *codes[:2]


def sketches(text: Column, words: int) -> Column:
    """A struct of node, a hash of the text's words, its sketch, and its number of shingles."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [(_node(x), *_sketch(h), len(h)) for x in texts for h in [_hashes(x, words)]]
            codes = np.array([r[2] for r in rows], np.int64).reshape(-1, len(CODES))
            yield pd.DataFrame({
                "node": np.array([r[0] for r in rows], np.int64), "keys": [r[1] for r in rows],
                **dict(zip(CODES, codes.T, strict=True)), "size": np.array([r[3] for r in rows], np.int32),
            })
        let_go()

    return F.pandas_udf(of, f"node long, keys array<int>, {', '.join(f'{c} long' for c in CODES)}, size int")(text)


def _node(text: str | None) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(_parts(text)), SEED)).view(np.int64))


@contextlib.contextmanager
def _small_batches(spark: SparkSession):
    """Texts are read and reach Python in batches of BATCH rows in plans that run inside."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, BATCH)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class _Sketched:
    """Rows of texts' first bits and, with ``least``, of their further bits and numbers of shingles."""

    def __init__(self, rows: pd.DataFrame, budget: int, least: float | None):
        self.budget, self.least = budget, least
        self.first, self.rest = ([rows[c].to_numpy().view(np.uint64) for c in names] for names in (CODES[:2], CODES[2:] if least else []))
        self.size = rows["size"].to_numpy() if least else None

    @staticmethod
    def _differ(codes: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return sum(np.bitwise_count(c[a] ^ c[b]) for c in codes)

    def close(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of pairs near by their first bits, those that by all bits and their sizes may be similar."""
        if self.least is None or not len(a):
            return np.ones(len(a), bool)
        small, large = np.minimum(self.size[a], self.size[b]), np.maximum(self.size[a], self.size[b])
        return (small + 1e-9 >= self.least * large) & (self._differ(self.first + self.rest, a, b) <= 2 * self.budget)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs (a, b) may be similar."""
        out = self._differ(self.first, a, b) <= self.budget
        out[out] = self.close(a[out], b[out])
        return out

    def met(self, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of rows with others that may be similar, as places in both, by rows."""
        at, to = np.nonzero(self._differ(self.first, rows[:, None], others) <= self.budget)
        close = self.close(rows[at], others[to])
        return at[close], to[close]


def _ends(codes: _Sketched, lo: int, hi: int, back: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every row of one bucket, lo to hi, its first near row before it, or with ``back`` its last one after it.

    PIVOTS rows meet all later ones at once. Rows near an early one leave at once.
    """
    todo = np.arange(hi - 2, lo - 1, -1) if back else np.arange(lo + 1, hi)
    order = np.arange(hi - 1, lo, -1) if back else np.arange(lo, hi - 1)
    for k in range(0, len(order), PIVOTS):
        pivots = order[k : k + PIVOTS]
        at, to = codes.met(todo, pivots)
        later = (todo[at] < pivots[to]) if back else (todo[at] > pivots[to])
        at, to = at[later], to[later]
        at, first = np.unique(at, return_index=True)
        yield pivots[to[first]], todo[at]
        open_ = np.ones(len(todo), bool)
        open_[at] = False
        todo = todo[open_ & ((todo < pivots[-1] - 1) if back else (todo > pivots[-1] + 1))]
        if not len(todo):
            return


def _bucket_pairs(every: bool, budget: int, least: float | None = None):
    """Pairs of nodes that share a bucket and differ in at most ``budget`` bits of 128; rows are sorted by bucket and node.

    With ``least`` they differ in at most twice as many of 256, too, and the smaller set of shingles is at least that part of
    the larger one: no more can be shared.

    Without ``every``: each row with its first near row before it and its last one after it. With it: of all that have
    different roots, pairs that connect the same rows. Either way their number is in proportion to the rows.
    """

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in runs_of(batches, BUCKET, CHUNK // 4):
            yield from in_runs(rows)

    def in_runs(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        codes = _Sketched(rows, budget, least)
        node, key = rows.node.to_numpy(), rows[BUCKET].to_numpy()
        root = rows.root.to_numpy() if every else node
        run = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
        end = np.append(run[1:], len(key))
        shared = (end - run > 1) & (np.minimum.reduceat(root, run) != np.maximum.reduceat(root, run))
        run, end = run[shared], end[shared]
        long = end - run > PIVOTS
        met = np.arange(len(node))
        for lo, hi in zip(run[long].tolist(), end[long].tolist(), strict=True):
            if not every:
                for a, b in _ends(codes, lo, hi):
                    yield pd.DataFrame({"a": node[a], "b": node[b]})
                for b, a in _ends(codes, lo, hi, back=True):
                    yield pd.DataFrame({"a": node[a], "b": node[b]})
                continue
            for k in range(lo, hi, PIVOTS):
                pivots, others = np.arange(k, min(k + PIVOTS, hi)), np.arange(k, hi)
                a, b = codes.met(pivots, others)
                a, b = pivots[a], others[b]
                apart = root[a] != root[b]
                if apart.any():  # folded in as they come
                    met = spanning(met[a[apart]], met[b[apart]], len(met))[met]
        lo = np.concatenate([np.arange(a, b) for a, b in zip(run[~long], end[~long], strict=True)] or [np.array([], np.int64)])
        hi = np.repeat(end[~long], (end - run)[~long])
        size = np.cumsum(hi - lo - 1)
        for at in np.split(np.arange(len(lo)), np.searchsorted(size, np.arange(CHUNK, size[-1] if len(size) else 0, CHUNK))):
            a, b = _expand(lo[at], np.ones(len(at), np.int64), lo[at] + 1, (hi - lo)[at] - 1)
            near = codes.near(a, b)
            near &= root[a] != root[b]
            a, b = a[near], b[near]
            if not every and len(a):  # a rises, and b within each a
                first = np.unique(b, return_index=True)[1]
                last = np.append(np.flatnonzero(a[1:] != a[:-1]), len(a) - 1)
                keep = np.union1d(first, last)
                a, b = a[keep], b[keep]
            if every and len(a):
                met = spanning(met[a], met[b], len(met))[met]
            elif len(a):
                yield pd.DataFrame({"a": node[a], "b": node[b]}).drop_duplicates()
        at = np.flatnonzero(met != np.arange(len(met)))
        if len(at):
            yield pd.DataFrame({"a": node[met[at]], "b": node[at]})

    return of


def _linked(words: int, least: float, budget: int):
    """Links (a, b) that connect all similar texts of one cluster and block pair whose roots are different.

    Texts that differ in over ``budget`` bits of 128, or twice as many of 256, aren't compared. Overlaps are counted on the shingles' hashes, one
    text against all, and what reaches ``least`` by them is compared by its shingles; a text meets no other that links
    have brought together with it.
    """

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in runs_of(batches, CLUSTER, BATCH):
            for _, run in rows.groupby(CLUSTER, sort=False):
                found = in_run(run.reset_index(drop=True))
                if found:
                    yield pd.DataFrame(found, columns=["a", "b"])

    def in_run(rows: pd.DataFrame) -> list[tuple[int, int]]:
        codes = _Sketched(rows, budget, least)
        node, block, size = rows.node.to_numpy(), rows.block.to_numpy(), rows["size"].to_numpy()
        root = np.unique(rows.root.to_numpy(), return_inverse=True)[1]
        inner, out = rows.block_i.iloc[0] == rows.block_j.iloc[0], []
        hashes = [_hashes(t, words) for t in rows.text]
        end = np.cumsum(size)
        number = np.unique(np.concatenate(hashes), return_inverse=True)[1]
        for k in range(len(rows) - 1):
            at = np.flatnonzero((root[k + 1 :] != root[k]) & ((block[k + 1 :] == block[k]) == inner)) + k + 1
            at = at[codes.near(np.full(len(at), k), at)]
            if not len(at):
                continue
            own = np.zeros(number.max() + 1, bool)
            own[number[end[k] - size[k] : end[k]]] = True
            shared = np.concatenate(([0], np.cumsum(own[number[end[k] :]])))
            both = shared[end[at] - end[k]] - shared[end[at] - size[at] - end[k]]
            for j in at[both + 1e-9 >= least * (size[at] + size[k] - both)].tolist():
                if root[j] != root[k] and similar(shingles(rows.text[k], words), shingles(rows.text[j], words), least):
                    out.append((node[k], node[j]))
                    root[root == root[j]] = root[k]
        return out

    return of


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.8, block_rows: int = 8192
) -> DataFrame:
    """One row per row of docs: its id and component_id, the smallest id that links reach.

    Two texts are linked if the sets of their shingles of ``words`` words have a Jaccard similarity of ``least`` or
    more. Candidates come from a SimHash of FIELDS x WIDTH bits: two texts that share one of its fields and differ in
    at most NEAR of its first 128 bits and twice as many of its first 256, of sizes that allow the similarity. By 128 bits
    alone chance brings texts together, as many pairs as the square of a table, until all are one cluster; by 256 it
    is one in a thousand million of those that share a field. A pair of long texts at 0.8 is expected to agree on 85 bits of 100, so one in
    830 shares no field; at 0.85, one in 25,000; for texts of under ten words at 0.8, one in 40. Each candidate is
    then compared by its shingles themselves. First each text is compared with its outermost candidates, the smallest
    and the largest node that FIRST_FIELDS of the fields give; of all fields the other pairs only where those left them
    in different components, so a group of near copies doesn't meet pair by pair. Those other pairs are never rows: what
    they connect is a cluster, whose texts are compared in tasks of TEXTS texts against TEXTS, and only links come out.
    A field's value shared by over ``block_rows`` texts is cut into block pairs.

    Nulls, repeated rows and empty tables are as in simhash_groups. Texts with the same words in lower case are one.
    """
    needs(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    with _small_batches(docs.sparkSession):
        made = rows.select("id", F.xxhash64("text").alias("hash"), sketches(F.col("text"), words).alias("s"))
        of = stored(made.select("id", "hash", "s.*"), "sketches")
    codes = of.select("node", "keys", *CODES, "size").dropDuplicates(["node"])

    def pairs(of_codes: DataFrame, every: bool) -> DataFrame:
        keys = F.col("keys") if every else F.slice("keys", 1, FIRST_FIELDS)
        placed = of_codes.select(F.explode(keys).alias("key"), *[c for c in of_codes.columns if c != "keys"])
        dealt = pair_blocks(placed, ["key"], "node", block_rows).drop("block")
        return dealt.repartition(*BUCKET).sortWithinPartitions(*BUCKET, "node").mapInPandas(_bucket_pairs(every, NEAR, least), "a long, b long")

    def texts_of(nodes: DataFrame, name: str) -> DataFrame:
        """(node, text), stored: one text of each of nodes."""
        named = stored(of.select("node", "hash").join(nodes, "node", "left_semi").dropDuplicates(["node"]), "named")
        texts = rows.select(F.xxhash64("text").alias("hash"), "text").join(named, "hash").dropDuplicates(["node"])
        with _small_batches(docs.sparkSession):
            return stored(texts.select("node", "text"), name)

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known: dict[int, set[bytes]] = {}
            ok = []
            for a, b, x, y in zip(batch.a, batch.b, batch.x, batch.y, strict=True):
                if a not in known:
                    known = {a: shingles(x, words)}
                ok.append(similar(known[a], shingles(y, words), least))
            yield batch.loc[np.array(ok, bool), ["a", "b"]]
        let_go()

    def links(found: DataFrame, texts: DataFrame) -> DataFrame:
        with _small_batches(docs.sparkSession):
            full = found.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b").join(
                texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a"
            )
            return stored(full.select("a", "b", "x", "y").mapInPandas(verified, "a long, b long"), "links")

    def inside(members: DataFrame, texts: DataFrame) -> DataFrame:
        more = stored(members.select("node").join(texts.select("node"), "node", "left_anti"), "more-nodes")
        dealt = stored(pair_blocks(members, ["cluster"], "node", TEXTS), "cluster-blocks")
        if not more.isEmpty():
            texts = texts.unionByName(texts_of(more, "more-texts"))
        with _small_batches(docs.sparkSession):
            met = dealt.join(texts, "node").repartition(*CLUSTER).sortWithinPartitions(*CLUSTER)
            return stored(met.mapInPandas(_linked(words, least, NEAR), "a long, b long"), "links")

    near = stored(pairs(codes, False), "near-rows")
    outer = stored(
        near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b").union(near.groupBy("a").agg(F.max("b").alias("b")).select("a", "b")).distinct(), "pairs"
    )
    ends = stored(outer.select(F.col("a").alias("node")).union(outer.select("b")).distinct(), "pair-ends")
    texts = texts_of(ends, "pair-texts")  # of nearly all that a cluster holds, too
    found = links(outer, texts)
    roots = components(found).withColumnRenamed("node", "n")
    open_ = stored(codes.select("node").join(roots, F.col("node") == F.col("n"), "left").select("node", F.coalesce("root", "node").alias("root")), "open")
    clusters = components(pairs(codes.join(open_, "node"), True)).withColumnRenamed("root", "cluster")
    members = stored(codes.select("node", *CODES, "size").join(open_, "node").join(clusters, "node"), "clusters")
    roots = components(found.unionByName(inside(members, texts)))
    lows = of.groupBy("node").agg(F.min("id").alias("low"))
    linked = stored(lows.join(roots, "node").select("node", "low", "root"), "linked")
    low = stored(linked.groupBy("root").agg(F.min("low").alias("component_id")), "lowest-ids")
    known = linked.join(low, "root").select("node", "component_id")
    alone = lows.join(linked.select("node"), "node", "left_anti").select("node", F.col("low").alias("component_id"))
    return of.select("id", "node").join(stored(alone.unionByName(known), "classes"), "node").select(F.col("id").alias(id_col), "component_id")


def similar_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.8) -> DataFrame:
    """docs without near copies by similar_groups; what stays of each component is as in simhash_dedup."""
    return _firsts(docs, similar_groups(docs.select(id_col, text_col), id_col, text_col, words, least), id_col, text_col)


def op2_query(spark, sf_dir: str) -> DataFrame:
    return simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
