"""SentencePiece BPE encoding by a prefix table, and decoding.

A merge-type encoding of a text is unique, and so is that of each of its prefixes. The table stores, for each prefix
of a chunk, the one token that its encoding ends with: of the tokens that end at that place (an automaton finds them)
it is the one that is compatible with the last token of the prefix before it, that is, the pair encodes to itself.
Reading the table backwards from the end gives the ids.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.common import fresh_name, let_go, needs

SPACE = "▁"  # the sign that stands for a space in pieces
CACHED_WORDS, CACHED_CHUNKS, CACHED_PAIRS = 400_000, 200_000, 300_000
ROWS_AT_ONCE = 500
_CHUNKS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class PrefixTableEncoder:
    """Encodes as the sentencepiece library does with a BPE model that has byte fallback and no normalisation."""

    def __init__(self, model: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        special = [sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(sp.vocab_size())]
        self.piece = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        self.score = [sp.get_score(i) for i in range(sp.vocab_size())]
        self.ids = {p: i for i, p in enumerate(self.piece) if not special[i]}
        if sp.vocab_size() > 1 << 16 or any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("models of over 65,536 pieces or with pieces that hold an inner space aren't supported")
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.end = sp.eos_id()
        self.single = {p for p in self.ids if len(p) == 1}
        if any(set(p) - self.single for p in self.ids):
            raise ValueError("every character of a piece must be a piece")
        self.decimal = [str(i) for i in range(sp.vocab_size())]
        #: Runs of spaces, all of one score, the least: they're joined last and from the left, so not by the table.
        self.runs = {p: i for p, i in self.ids.items() if len(p) > 1 and not p.strip(SPACE)}
        if self.runs and {self.score[i] for i in self.runs.values()} != {min(self.score[i] for i in self.ids.values())}:
            raise ValueError("runs of spaces must have the least score")
        #: Neighbouring characters inside pieces: between any others no merge can happen.
        self.inside = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        #: For each piece that merging can make, its rank in time and its two halves; single characters are there at first.
        rank = {i: r for r, i in enumerate(sorted(self.ids.values(), key=lambda i: (-self.score[i], i)))}
        self.rank, self.left, self.right = ([-1] * sp.vocab_size() for _ in range(3))
        self.joined: dict[int, int] = {}
        self.ends = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if p in self.runs:
                continue
            if len(p) > 1:
                for k in range(1, len(p)):
                    if p[:k] in self.ids and p[k:] in self.ids:
                        self.joined[self.ids[p[:k]] << 16 | self.ids[p[k:]]] = rank[i]
                if not (halves := self._halves(p)):
                    continue
                self.rank[i], self.left[i], self.right[i] = rank[i], *halves
            self.ends.add_word(p, (len(p), i))
        self.ends.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}  # chunks as they stand
        self.spaced: dict[str, bytes] = {}  # words that follow a space
        self.newline = self._chunk("\n")

    def _halves(self, piece: str) -> tuple[int, int] | None:
        """The two tokens whose merge makes the piece last; None if merging its characters ends otherwise.

        Merging joins the neighbours with the best score, the leftmost of equal ones, until none can be joined.
        """
        parts = list(piece)
        while len(parts) > 2:
            able = [(self.score[self.ids[x]], -k) for k in range(len(parts) - 1) if (x := parts[k] + parts[k + 1]) in self.ids]
            if not able:
                return None
            k = -max(able)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return self.ids[parts[0]], self.ids[parts[1]]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the texts of two tokens, one after the other, encode to just these two.

        Undoes their merges, the latest first (of equal ones the right one, as the left one came first), and looks
        whether the tokens at the border would have been joined before the merge that was undone.
        """
        rank, before = self.rank, 1 << 30
        while True:
            if self.joined.get(left << 16 | right, 1 << 30) < before:
                return False
            if rank[left] > rank[right]:
                before = rank[left]
                left = self.right[left]
            elif rank[right] >= 0:
                before = rank[right] + 1
                right = self.left[right]
            else:
                return True

    def _run(self, text: str) -> list[int]:
        """The ids of a text whose characters are all pieces."""
        last, pairs = [0] * len(text), self.pairs
        for at, (n, i) in self.ends.iter(text):
            if last[at]:
                continue
            if n <= at:
                pair = last[at - n] << 16 | i
                if (ok := pairs.get(pair)) is None:
                    if len(pairs) >= CACHED_PAIRS:
                        pairs.clear()
                    ok = pairs[pair] = self._compatible(last[at - n], i)
                if not ok:
                    continue
            last[at] = i
        out, at, piece = [], len(text), self.piece
        while at:
            out.append(last[at - 1])
            at -= len(piece[last[at - 1]])
        return self._join_runs(out[::-1]) if text.startswith(SPACE * 2) else out[::-1]

    def _join_runs(self, ids: list[int]) -> list[int]:
        """ids with the spaces at their start joined to runs, the leftmost pair first."""
        space, stack = self.ids[SPACE], []
        n = next((k for k, i in enumerate(ids) if i != space), len(ids))
        for _ in range(n):
            stack.append(SPACE)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.runs:
                stack[-2:] = [stack[-2] + stack[-1]]
        return [self.ids[x] for x in stack] + ids[n:]

    def _part(self, text: str) -> bytes:
        """The ids, two bytes each, of a text in which every two neighbours can meet inside a piece."""
        if len(text) == 1 and text not in self.single:
            ids = [self.byte_ids[b] for b in text.encode("utf-8", "replace")]
        else:
            ids = self._run(text)
        return array("H", ids).tobytes()

    def _chunk(self, text: str) -> bytes:
        """The ids of any text that starts no run of spaces in its middle; cut where no merge can happen."""
        inside, known = self.inside, self.known
        cuts = [0, *[k for k in range(1, len(text)) if text[k - 1 : k + 1] not in inside], len(text)]
        parts = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = text[a:b]
            found = known.get(part)
            if found is None:
                found = self._part(part)
                if b - a <= 40:
                    if len(known) >= CACHED_CHUNKS:
                        known.clear()
                    known[part] = found
            parts.append(found)
        return b"".join(parts)

    def _spaced(self, word: str) -> bytes:
        found = self._chunk(SPACE + word)
        if len(word) <= 40:
            if len(self.spaced) >= CACHED_WORDS:
                self.spaced.clear()
            self.spaced[word] = found
        return found

    def encode(self, text: str | None) -> list[int]:
        """All ids and the end id. Null is the empty text."""
        parts: list[bytes] = []
        get, new = self.spaced.get, self._spaced
        plain = SPACE not in (text or "")
        for n, line in enumerate(text.split("\n") if text else ()):
            if n:
                parts.append(self.newline)
            if plain and "  " not in line and (n or line[:1] != " "):
                words = line.split(" ")
                if n and (first := words.pop(0)):
                    parts.append(self._chunk(first))
                parts += [get(w) or new(w) for w in words]
            else:
                parts += [self._chunk(x) for x in _CHUNKS.findall((SPACE if not n else "") + line.replace(" ", SPACE))]
        ids = array("H", b"".join(parts)).tolist()
        ids.append(self.end)
        return ids

    def forget(self) -> None:
        """Empties the caches, as a worker may go on to other work."""
        for cache in (self.known, self.spaced, self.pairs):
            cache.clear()

    def shown(self, ids: list[int]) -> str:
        """The ids in decimal, joined by one space."""
        return " ".join([self.decimal[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(2)
def encoder(model: str) -> PrefixTableEncoder:
    return PrefixTableEncoder(model)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def sentencepiece_encode(
    docs: DataFrame, text_col: str = "text", model: str | None = None, with_ids: bool = True, with_decoded: bool = False
) -> DataFrame:
    """docs without ``text_col`` and with n_tokens, ids_sha256, decoded_sha256, and ids and decoded if asked for.

    Every whole text is encoded, with an end id only, and decoded again. ``model`` is a path that each executor has;
    by default the public 32k BPE model. Nulls: a null text is encoded as an empty one (the end id alone). Very long
    texts: the table is built chunk by chunk, so memory follows one text. Repeated rows: each is returned; an empty
    table gives no rows. New columns that clash with one of docs get a leading underscore.
    """
    needs(docs, text_col)
    kept = [c for c in docs.columns if c != text_col]
    names = {}
    for c in ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids + ["decoded"] * with_decoded:
        names[c] = fresh_name(kept, c)
    kinds = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "ids": "array<int>", "decoded": "string"}

    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = encoder(model or default_model())
        for batch in texts:
            for at in range(0, len(batch), ROWS_AT_ONCE):  # bounds the ids that wait to leave
                rows = []
                for text in batch.iloc[at : at + ROWS_AT_ONCE]:
                    ids = codec.encode(text)
                    decoded = codec.decode(ids)
                    row = {
                        "n_tokens": len(ids),
                        "ids_sha256": hashlib.sha256(codec.shown(ids).encode()).hexdigest(),
                        "decoded_sha256": hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest(),
                    }
                    rows.append(row | ({"ids": np.array(ids, np.int32)} if with_ids else {}) | ({"decoded": decoded} if with_decoded else {}))
                yield pd.DataFrame(rows, columns=list(names))
        codec.forget()
        let_go()

    udf = F.pandas_udf(of, ", ".join(f"{c} {kinds[c]}" for c in names))
    at = fresh_name(docs.columns, "encoded")
    return docs.withColumn(at, udf(F.col(text_col))).select(*kept, *[F.col(f"{at}.{c}").alias(names[c]) for c in names])


def sentencepiece_decode(rows: DataFrame, ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """rows with the text that ``ids_col`` decodes to; null ids give a null text. A clashing name gets an underscore."""
    needs(rows, ids_col)

    @F.pandas_udf("string")
    def of(ids: pd.Series) -> pd.Series:
        codec = encoder(model or default_model())
        return pd.Series([None if x is None else codec.decode([int(i) for i in x]) for x in ids], dtype=object)

    return rows.withColumn(fresh_name(rows.columns, "text"), of(F.col(ids_col)))


def op10_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return sentencepiece_encode(docs, with_ids=False)
