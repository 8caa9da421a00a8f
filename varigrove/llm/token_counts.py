"""Token counts by rank-synchronous merging of ragged arrays.

The pre-tokens of a batch lie end to end in one numpy array of symbols. A round
finds, in every sequence at once, its pair of lowest rank, merges all places of
that pair, and goes on with the sequences that still have a pair to merge. The
symbols that survive are counted; no string is built and no sequence is looped
over.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varigrove.llm import pieces
from varigrove.llm.common import in_slices, quoted

_NONE = np.int32(2**31 - 1)
_SLOTS = 1 << 18


class Merges:
    """Ranks and results of the pairs of a vocabulary, looked up for whole arrays."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        letters = pieces.byte_letters()
        self.of_byte = np.array([vocabulary[letters[b]] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        left = np.array([vocabulary[a] for a, _ in pairs], np.uint64)
        right = np.array([vocabulary[b] for _, b in pairs], np.uint64)
        keys, ranks = left << np.uint64(32) | right, np.arange(len(pairs), dtype=np.int32)
        #: Hash tables; what finds its slot taken goes to the next table.
        self.tables: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        while len(keys):
            factor = np.uint64((0x9E3779B97F4A7C15 + 0x632BE59BD9B4E01A * len(self.tables)) % 2**64 | 1)
            slot = self._slot(keys, factor)
            _, first = np.unique(slot, return_index=True)
            held, rank = np.full(_SLOTS, 2**64 - 1, np.uint64), np.full(_SLOTS, _NONE, np.int32)
            held[slot[first]], rank[slot[first]] = keys[first], ranks[first]
            self.tables.append((factor, held, rank))
            keys, ranks = np.delete(keys, first), np.delete(ranks, first)

    @staticmethod
    def _slot(keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return (keys * factor >> np.uint64(46)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        out = np.full(len(keys), _NONE, np.int32)
        for factor, held, rank in self.tables:
            slot = self._slot(keys, factor)
            out = np.where(held[slot] == keys, rank[slot], out)
        return out

    def counts(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left of each sequence of bytes; an empty one has none."""
        sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
        out = sizes.copy()
        ids = np.flatnonzero(sizes > 1)  # the sequences still merging
        if not len(ids):
            return out
        symbols = self.of_byte[np.frombuffer(b"".join(sequences[i] for i in ids.tolist()), np.uint8)]
        sizes = sizes[ids]
        ranks = self._all_ranks(symbols, sizes)
        while len(ids):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == _NONE
            if done.any():
                out[ids[done]] = sizes[done]
                keep = np.repeat(~done, sizes)
                symbols, ranks = symbols[keep], ranks[keep]
                ids, sizes, lowest = ids[~done], sizes[~done], lowest[~done]
                if not len(ids):
                    break
            hit = ranks == np.repeat(lowest, sizes)
            # Of places that overlap (a a a), every second one counts, from the left.
            at = np.flatnonzero(hit)
            fresh = np.ones(len(at), bool)
            fresh[1:] = at[1:] != at[:-1] + 1
            order = np.arange(len(at))
            at = at[(order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            owner = np.repeat(np.arange(len(ids)), sizes)
            sizes = sizes - np.bincount(owner[at], minlength=len(ids))
            # What ended after the second symbol of a pair now follows the merged one.
            ranks[at] = ranks[at + 1]
            now = at - np.arange(len(at))
            symbols, ranks = symbols[keep], ranks[keep]
            ends = np.cumsum(sizes) - 1
            last = np.zeros(len(symbols), bool)
            last[ends] = True
            self._renew(symbols, ranks, now[~last[now]])
            before = now[now > 0] - 1
            self._renew(symbols, ranks, before[~last[before]])
        return out

    def _renew(self, symbols: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> None:
        ranks[at] = self.ranks(symbols[at], symbols[at + 1])

    def _all_ranks(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each symbol the rank of the pair it begins; none at the end of a sequence."""
        out = np.append(self.ranks(symbols[:-1], symbols[1:]), _NONE)
        out[np.cumsum(sizes) - 1] = _NONE
        return out


class Counter:
    """Counts tokens of texts; pieces met before are looked up."""

    _loaded: dict[str, Counter] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.merges = Merges(model["model"]["vocab"], model["model"]["merges"])
        self.special = pieces.special_pattern([t["content"] for t in model["added_tokens"]])
        self.pieces: dict[str, int] = {}
        self.tokens: dict[str, int] = {}

    @classmethod
    def of(cls, path: str) -> Counter:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def counts(self, texts: list[str]) -> list[int]:
        cuts = [pieces.cut(t) if t else [] for t in texts]
        known = self.pieces.get
        new = {p for ps in cuts for p in ps[1:] if p not in self.pieces}
        heads = [ps[0] for ps in cuts if ps]
        fresh = self._count([" " + p for p in new] + heads)
        told = dict(zip(new, fresh, strict=False))
        out, head = [], iter(fresh[len(new) :])
        for ps in cuts:
            own = [known(p) for p in ps[1:]]
            if None in own:
                own = [told[p] if n is None else n for n, p in zip(own, ps[1:], strict=True)]
            out.append(sum(own) + (next(head) if ps else 0))
        for piece, n in told.items():
            if len(piece) <= pieces.LONGEST and len(self.pieces) < pieces.KEPT_PIECES:
                self.pieces[piece] = n
        return out

    def _count(self, parts: list[str]) -> list[int]:
        """Tokens of each part; the pre-tokens not met before are merged all at once."""
        index: dict[str, int] = {}
        known, out = self.tokens, np.zeros(len(parts), np.int64)
        owner, which = [], []
        for n, part in enumerate(parts):
            for i, stretch in enumerate(self.special.split(part) if self.special else [part]):
                if i % 2:  # a special string, which the library takes as one token
                    out[n] += 1
                    continue
                for token in pieces.PRETOKEN.findall(stretch):
                    if token in known:
                        out[n] += known[token]
                    else:
                        owner.append(n)
                        which.append(index.setdefault(token, len(index)))
        if owner:
            each = self.merges.counts([t.encode("utf-8", "replace") for t in index])
            np.add.at(out, owner, each[which])
            for token, n in zip(index, each.tolist(), strict=True):
                if len(token) <= pieces.LONGEST and len(known) < pieces.KEPT_TOKENS:
                    known[token] = n
        return out.tolist()


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of `docs`.

    `path` is a byte-level BPE file of the tokenizers library; the counts are
    the library's, without added tokens, with special strings in a text as its
    default has them. Null and empty texts have 0 tokens; null ids, repeated
    rows and ties are answered row by row; other columns are not read.
    """

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(Counter.of(path).counts(texts), pa.int64()), batch.column(2)], names=["doc_id", "n_tokens", "n_bytes"]
        )

    whole = F.coalesce(quoted(text).cast("string"), F.lit(""))
    rows = docs.select(quoted(key).alias("doc_id"), whole.alias("text"), F.octet_length(whole).cast("long").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(in_slices(convert), f"doc_id {kind}, n_tokens long, n_bytes long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
