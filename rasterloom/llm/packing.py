"""Packing documents into sequences of at most ``capacity`` tokens by cutting-stock column generation.

Whole documents of up to ``capacity`` tokens are packed by patterns: how many documents of each length class fill one
sequence. Their numbers come from a linear program over the histogram of lengths, whose columns a knapsack dynamic
programme prices one by one, and are rounded. Documents are ranked in their class, longest first, and a rank says
which sequence a document goes to. All others, those over ``capacity`` and the few that rounding leaves, are laid end to
end on one line; the line is cut into the gaps that patterns leave, then into full sequences, and what is left at its end
into powers of two. So no sequence is padded. The driver sees the histogram, at most ``capacity`` rows; ranks and the
line's places are sums over ranges, and no task holds more than a cell of the line or one document.
"""

from __future__ import annotations

import json
import string
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rasterloom.llm.common import fresh_folder, let_go, needs, placed, stored

CLASSES = 128  # lengths are rounded up to multiples of capacity / CLASSES in patterns
CELL = 1 << 14  # tokens of the gaps that one group holds
CACHED_WORDS = 600_000
ROWS_AT_ONCE = 500
# How the public word tokenizer cuts a text. White space ends every piece and is dropped.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = ["NFC", "Replace", "Lowercase"]
ENDS = string.punctuation  # taken off a word's end before its letters are looked up; such a run is one piece
LATIN_END = "\u0250"  # Latin letters before this one are composed and have one small letter, but for one
DOTTED = "\u0130"


# --- ids ---


class _Known(dict):
    """What words give, found by ``make`` where a word is new; emptied when full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        found = self.make(word)
        if len(word) <= 40:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = found
        return found


class WordIds:
    """The ids of whole texts as little-endian numbers of ``width`` bytes, as the tokenizers library gives them.

    Where the tokenizer drops white space and nothing reaches across it, words are encoded one by one and remembered.
    """

    def __init__(self, path: str, end_id: int):
        self.library, self.known = Tokenizer.from_file(path), _Known(self._word)
        with open(path, encoding="utf-8") as f:
            how = json.load(f)
        steps = [s["type"] for s in (how.get("normalizer") or {}).get("normalizers", [])]
        cuts = ((how.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        added = how.get("added_tokens") or []
        self.by_words = (
            steps == _NORMAL and cuts.get("pattern") == {"Regex": _WORDS} and cuts.get("invert") and cuts.get("behavior") == "Removed"
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"] for t in added)
        )
        self.model = self.library.model
        #: Bytes as the model's letters show them: printable ones as they are, the others from 256 on.
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.shown = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}
        self.width = 2 if max(self.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.end = self._bytes([end_id])

    def _bytes(self, ids: list[int]) -> bytes:
        return array("H" if self.width == 2 else "I", ids).tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of a word. A run of Latin letters is one piece of the model, so the steps before it can be left out."""
        core = word.rstrip(ENDS)
        if not core.isalpha() or not core.isascii() and (max(core) >= LATIN_END or DOTTED in core):
            return self._bytes(self.library.encode(word, add_special_tokens=False).ids)
        if len(core) < len(word):
            return self.known[core] + self.known[word[len(core) :]]
        low = core.lower()
        if low != core:
            return self.known[low]
        text = low if low.isascii() else low.encode().decode("latin-1").translate(self.shown)
        return self._bytes([t.id for t in self.model.tokenize(text)])

    def encode(self, text: str | None) -> bytes:
        """All ids of a text, null as an empty one, and the end id."""
        if not self.by_words:
            return self._bytes(self.library.encode(text or "", add_special_tokens=False).ids) + self.end
        return b"".join(map(self.known.__getitem__, (text or "").replace("\n", " ").split(" "))) + self.end


@lru_cache(2)
def _encoder(path: str, end_id: int) -> WordIds:
    return WordIds(path, end_id)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_ids(docs: DataFrame, text_col: str, tokenizer: str | None, end_id: int) -> tuple[DataFrame, int]:
    """docs without the text, stored, with key (a number for each row), tokens and ids; and the bytes of one id."""
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _encoder(tokenizer or default_tokenizer(), end_id)
        for batch in texts:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                ids = [codec.encode(t) for t in batch.iloc[at : at + ROWS_AT_ONCE]]
                yield pd.DataFrame({"tokens": [len(x) // codec.width for x in ids], "ids": ids})
        codec.known.clear()
        let_go()

    udf = F.pandas_udf(of, "tokens long, ids binary")
    rows = docs.withColumn("_of", udf(F.col(text_col))).drop(text_col)
    rows = rows.select(F.monotonically_increasing_id().alias("key"), *[c for c in rows.columns if c != "_of"], "_of.tokens", "_of.ids")
    folder = fresh_folder(docs.sparkSession, "token-ids")
    rows.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(rows.schema).parquet(folder), _encoder(tokenizer or default_tokenizer(), end_id).width


# --- the plan, of the histogram alone ---


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of the largest price within capacity, by dynamic programming over filled capacity."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    useful = np.flatnonzero(prices > 0)
    order = useful[np.argsort(sizes[useful], kind="stable")]
    price, size = prices[order], sizes[order]
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = np.searchsorted(size, room, side="right")
        if fits:
            worth = price[:fits] + best[room - size[:fits]]
            k = int(worth.argmax())
            if worth[k] > best[room] + 1e-12:
                best[room], choice[room] = worth[k], order[k]
    pattern, room = np.zeros(len(prices), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
            continue
        pattern[choice[room]] += 1
        room -= int(sizes[choice[room]])
    return float(best[capacity]), pattern


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, max_steps: int = 5_000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used, as a fraction, so that all demand is met by the fewest sequences.

    A revised simplex with columns priced by ``best_pattern``; it stops when no pattern is worth more than a sequence.
    Demands are raised by different amounts of less than a thousandth of a document, so no step leaves the cost as it is
    and none comes round again. ``max_steps`` is a guard: what it leaves is a feasible plan too.
    """
    m = len(sizes)
    if not m:
        return np.zeros((0, 0), np.int64), np.zeros(0)
    columns = np.diag(capacity // sizes).astype(float)  # a column for each pattern in use
    costs, inverse = np.ones(m), np.diag(1.0 / (capacity // sizes))
    demand = demand + 1e-3 * np.modf((np.arange(m) + 1) * 0.6180339887498949)[0]
    for step in range(max_steps):
        prices = costs @ inverse
        low = int(prices.argmin())
        if prices[low] < -1e-7:  # more of this class than asked for costs nothing
            entering, cost = -np.eye(m)[low], 0.0
        else:
            worth, pattern = best_pattern(prices, sizes, capacity)
            if worth <= 1 + 1e-7:
                break
            entering, cost = pattern.astype(float), 1.0
        used, turn = inverse @ demand, inverse @ entering
        able = turn > 1e-9
        if not able.any():
            break
        ratio = np.where(able, np.maximum(used, 0) / np.where(able, turn, 1), np.inf)
        leaving = int(ratio.argmin())
        columns[:, leaving], costs[leaving] = entering, cost
        inverse[leaving] /= turn[leaving]
        others = np.arange(m) != leaving
        inverse[others] -= np.outer(turn[others], inverse[leaving])
        if step % 100 == 99:  # a Newton step takes away what rounding has added up
            inverse = inverse @ (2 * np.eye(m) - columns @ inverse)
    used = np.maximum(inverse @ demand, 0)
    kept = costs > 0
    return columns.T[kept].astype(np.int64), used[kept]


@dataclass
class Plan:
    """Which sequence a document of a class and rank goes to, and how the line of all others is cut."""

    capacity: int
    unit: int
    sequences: int = 0  # made by patterns
    gaps: int = 0  # tokens that they leave
    line: int = 0  # tokens of all other documents
    #: For each class: the first rank, documents in a sequence, first sequence and place in it, of each pattern in turn.
    turns: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    covered: dict[int, int] = field(default_factory=dict)

    def places(self, classes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequence (-1: none) and the place in it."""
        sequence, place = np.full(len(classes), -1, np.int64), np.zeros(len(classes), np.int64)
        for c in np.unique(classes):
            if c not in self.turns:
                continue
            first, each, begin, at = self.turns[c]
            rows = np.flatnonzero((classes == c) & (ranks < self.covered[c]))
            k = np.searchsorted(first, ranks[rows], side="right") - 1
            into = ranks[rows] - first[k]
            sequence[rows], place[rows] = begin[k] + into // each[k], at[k] + into % each[k]
        return sequence, place

    def slots(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and sequence of the line's new sequences that start in [begin, end)."""
        whole = (self.line - self.gaps) // self.capacity
        k = np.arange(max(0, -(-(begin - self.gaps) // self.capacity)), min(whole, max(0, -(-(end - self.gaps) // self.capacity))))
        start, length, sequence = [self.gaps + k * self.capacity], [np.full(len(k), self.capacity)], [self.sequences + k]
        at, n = self.gaps + whole * self.capacity, self.sequences + whole
        for bit in reversed(range(self.capacity.bit_length())):  # the rest, in powers of two
            if (self.line - self.gaps) % self.capacity >> bit & 1:
                if begin <= at < end:
                    start.append(np.array([at]))
                    length.append(np.array([1 << bit]))
                    sequence.append(np.array([n]))
                at, n = at + (1 << bit), n + 1
        return np.concatenate(start).astype(np.int64), np.concatenate(length).astype(np.int64), np.concatenate(sequence).astype(np.int64)


def plan(histogram: dict[int, int], longer: int, capacity: int) -> Plan:
    """The plan for documents whose lengths up to capacity ``histogram`` counts, beside ``longer`` tokens of longer ones.

    Patterns are taken as often as the line can fill their gaps: where long documents are few, every pattern is used a
    64th less often until the documents set free suffice.
    """
    unit = max(1, capacity // CLASSES)
    lengths: dict[int, list[tuple[int, int]]] = {}
    for n in sorted(histogram, reverse=True):
        lengths.setdefault(-(-n // unit), []).append((n, histogram[n]))
    classes = sorted(lengths)
    demand = np.array([sum(c for _, c in lengths[k]) for k in classes], float)
    patterns, used = cutting_stock(np.array(classes, np.int64), demand, capacity // unit)
    times, left = np.floor(used).astype(np.int64), demand.astype(np.int64)
    for p in np.argsort(-times, kind="stable"):  # a class may be asked for more than it has
        for k in np.flatnonzero(patterns[p]):
            times[p] = min(times[p], left[k] // patterns[p, k])
        left -= times[p] * patterns[p]
    for p in np.argsort(-(used - np.floor(used)), kind="stable"):
        if (patterns[p] <= left).all():
            times[p] += 1
            left -= patterns[p]
    total = longer + sum(n * c for n, c in histogram.items())
    for share in range(64, -1, -1):
        taken = times * share // 64
        out = Plan(capacity, unit, int(taken.sum()))
        covered, filled = taken @ patterns if len(patterns) else np.zeros(0, np.int64), 0
        for k, c in enumerate(classes):
            out.covered[c], rest = int(covered[k]), int(covered[k])
            for n, count in lengths[c]:
                filled += n * min(count, rest)
                rest -= min(count, rest)
        out.gaps, out.line = out.sequences * capacity - filled, total - filled
        if out.gaps <= out.line:
            break
    begins = np.cumsum(np.append(0, taken[:-1])) if len(taken) else np.zeros(0, np.int64)
    places = np.cumsum(patterns, axis=1) - patterns if len(patterns) else patterns
    for k, c in enumerate(classes):
        mine = np.flatnonzero((patterns[:, k] > 0) & (taken > 0))
        if len(mine):
            slots = taken[mine] * patterns[mine, k]
            out.turns[c] = (np.cumsum(slots) - slots, patterns[mine, k], begins[mine], places[mine, k])
    return out


# --- on Spark ---

_PIECES = "key long, start long, length long, sequence_id long, offset long"


def _fill_gaps(line: DataFrame, gaps: DataFrame, made: Plan) -> DataFrame:
    """Pieces of the line's documents (key, begins, tokens) that fill gaps (sequence_id, filled, gap, begins).

    The line's start, as long as all gaps, is cut into cells. A cell holds the gaps that begin in it, so no piece ends at
    a cell's border for its own sake, and the documents that may reach into them.
    """
    first = F.greatest(F.col("begins") - (made.capacity - 1), F.lit(0))
    last = F.least(F.col("begins") + F.col("tokens"), F.lit(made.gaps)) - 1
    docs = line.filter(F.col("begins") < made.gaps).withColumn("cell", F.explode(F.sequence(F.floor(first / CELL), F.floor(last / CELL))))
    slots = gaps.withColumn("cell", F.floor(F.col("begins") / CELL))

    def of(docs: pd.DataFrame, slots: pd.DataFrame) -> pd.DataFrame:
        if not len(slots):
            return pd.DataFrame({c.split()[0]: [] for c in _PIECES.split(", ")})
        docs, slots = docs.sort_values("begins"), slots.sort_values("begins")
        begins, start = docs["begins"].to_numpy(np.int64), slots["begins"].to_numpy(np.int64)
        end = start[-1] + slots["gap"].iloc[-1]
        cuts = np.union1d(start, begins[(begins > start[0]) & (begins < end)])
        doc, slot = np.searchsorted(begins, cuts, side="right") - 1, np.searchsorted(start, cuts, side="right") - 1
        return pd.DataFrame({
            "key": docs["key"].to_numpy()[doc], "start": cuts - begins[doc], "length": np.append(cuts[1:], end) - cuts,
            "sequence_id": slots["sequence_id"].to_numpy()[slot], "offset": slots["filled"].to_numpy()[slot] + cuts - start[slot],
        })

    return docs.groupBy("cell").cogroup(slots.groupBy("cell")).applyInPandas(of, _PIECES)


def _new_sequences(line: DataFrame, made: Plan) -> DataFrame:
    """Pieces of the line's documents beyond the gaps: where sequences begin there is arithmetic, so nothing is dealt anew."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [[np.zeros(0, np.int64)] for _ in range(5)]
            for key, begins, tokens in zip(batch["key"], batch["begins"], batch["tokens"], strict=True):
                low, end = max(begins, made.gaps), begins + tokens
                at, length, sequence = made.slots(low - made.capacity + 1, end)
                first = int(np.searchsorted(at + length, low, side="right"))
                at, stop, sequence = at[first:], np.minimum((at + length)[first:], end), sequence[first:]
                begin = np.maximum(at, low)
                for into, x in zip(parts, (np.full(len(at), key), begin - begins, stop - begin, sequence, begin - at), strict=True):
                    into.append(x)
            yield pd.DataFrame({c.split()[0]: np.concatenate(x) for c, x in zip(_PIECES.split(", "), parts, strict=True)})

    return line.filter(F.col("begins") + F.col("tokens") > made.gaps).select("key", "begins", "tokens").mapInPandas(of, _PIECES)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = 2048, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """One row for each piece: id_col, start, length, ids, ids_crc32, doc_tokens, sequence_id and offset.

    Whole texts are encoded without special tokens and end with ``end_id``. A piece is ``length`` ids of its document
    from ``start``, as little-endian 32-bit numbers in ``ids`` (left out without ``with_ids``), and stands at ``offset`` of its sequence. Every id is in
    one piece; a sequence has no gap and at most ``capacity`` ids, and all sequences are full but for at most
    log2(capacity) at the end of the line, whose lengths are different powers of two.

    ``tokenizer`` is a path that each executor has. Nulls: a null text is the end id alone, a null id stays null. Ties and
    repeated rows: each row is a document. Very long texts are cut into many pieces; memory follows one text. An empty
    table gives no rows. Other columns of docs aren't returned, so names can't clash.
    """
    needs(docs, id_col, text_col)
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    rows, width = token_ids(docs.select(F.col(id_col).alias("id_"), text_col), text_col, tokenizer, end_id)
    lengths = rows.select("key", "tokens")
    counted = lengths.groupBy(F.when(F.col("tokens") <= capacity, F.col("tokens")).alias("n")).agg(F.count(F.lit(1)).alias("c"), F.sum("tokens").alias("s"))
    counts = counted.collect()  # at most capacity + 1 rows
    made = plan({r["n"]: r["c"] for r in counts if r["n"] is not None}, sum(r["s"] for r in counts if r["n"] is None), capacity)

    @F.pandas_udf("sequence_id long, place long")
    def seat(classes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, place = made.places(classes.to_numpy(np.int64), ranks.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "place": place})

    short = lengths.filter(F.col("tokens") <= capacity)
    short = short.select("key", "tokens", F.ceil(F.col("tokens") / made.unit).alias("class"), (-F.col("tokens")).alias("longest_first"))
    ranked = placed(short, ["class"], ["longest_first", "key"], rank="rank").withColumn("seat", seat("class", "rank"))
    seated = stored(ranked.select("key", "tokens", "seat.sequence_id", "seat.place"), "seats")
    whole, others = seated.filter("sequence_id >= 0"), seated.filter("sequence_id < 0").select("key", "tokens")
    before = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    whole_pieces = whole.select(
        "key", F.lit(0).cast("long").alias("start"), F.col("tokens").alias("length"), "sequence_id", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset")
    )
    line = placed(stored(others.unionByName(lengths.filter(F.col("tokens") > capacity)), "line"), [], ["key"], rank="rank", size="tokens", before="begins")
    filled = whole.groupBy("sequence_id").agg(F.sum("tokens").alias("filled")).withColumn("gap", F.lit(capacity) - F.col("filled")).filter("gap > 0")
    gaps = placed(stored(filled, "gaps"), [], ["sequence_id"], rank="rank", size="gap", before="begins")
    pieces = whole_pieces.unionByName(_fill_gaps(line.drop("rank"), gaps.drop("rank"), made)).unionByName(_new_sequences(line, made))
    parts = F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset")))
    names = ["start", "length", "sequence_id", "offset"]
    listed = pieces.groupBy("key").agg(parts.alias("parts")).select("key", *[F.col(f"parts.{c}").alias(c) for c in names])
    kind = docs.schema[id_col].dataType.simpleString()

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                some = batch.iloc[at : at + ROWS_AT_ONCE]
                times = some["start"].map(len).to_numpy()
                cuts = [
                    np.frombuffer(ids, f"<u{width}")[a : a + n].astype("<u4").tobytes()
                    for ids, starts, counts in zip(some["ids"], some["start"], some["length"], strict=True) for a, n in zip(starts, counts, strict=True)
                ]
                out = {"id_": some["id_"].repeat(times).to_numpy(), "doc_tokens": some["tokens"].repeat(times).to_numpy(), "ids_crc32": list(map(zlib.crc32, cuts))}
                out |= {"ids": cuts} if with_ids else {}
                yield pd.DataFrame(out | {c: np.concatenate(some[c].to_list()) for c in names})
        let_go()

    out = rows.join(listed, "key").select("id_", "tokens", "ids", *names)
    ids = ["ids"] * with_ids
    out = out.mapInPandas(of, f"id_ {kind}, doc_tokens long, ids_crc32 long, start long, length long, sequence_id long, offset long" + ", ids binary" * with_ids)
    return out.select(F.col("id_").alias(id_col), "start", "length", *ids, "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, with_ids=False)
