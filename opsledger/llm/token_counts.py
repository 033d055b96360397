"""Token counts of whole texts by rank-synchronous array merging.

The vocabulary of a sentencepiece BPE model becomes a table of pairs: (left piece, right
piece) -> (joined piece, rank of its score). A batch's distinct pre-tokens lie as ragged numpy
arrays of symbols; in each step every sequence applies its lowest-rank pair at the same
time, until no sequence has a pair left. Surviving symbols are counted; a character without
a piece counts its UTF-8 bytes (byte fallback).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared
from .ragged import Known, buffers

_NONE = np.int32(2**31 - 1)
SPACE = "▁"


class MergeTable:
    """Pairs of a BPE vocabulary with byte fallback, as sorted arrays."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        if not any(sp.is_byte(i) for i in range(sp.get_piece_size())):
            raise ValueError("only models with byte fallback are supported")
        if sp.normalize("a  Ａ") not in (f"{SPACE}a{SPACE}{SPACE}Ａ", f"a{SPACE}{SPACE}Ａ"):
            raise ValueError("only models without text normalisation are supported")
        self.dummy_space = sp.normalize("a").startswith(SPACE)
        usual = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i): i for i in usual}
        if any(SPACE in p.lstrip(SPACE) for p in pieces) or any("\n" in p for p in pieces):
            raise ValueError("pieces that run over a space or line end are not supported")
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in usual}, reverse=True))}
        self.size = sp.get_piece_size()
        pairs = [(pieces[p[:k]] * self.size + pieces[p[k:]], i, order[sp.get_score(i)]) for p, i in pieces.items() for k in range(1, len(p)) if p[:k] in pieces and p[k:] in pieces]
        pairs.sort()
        self.keys = np.array([x[0] for x in pairs], np.int64)
        self.joined = np.array([x[1] for x in pairs], np.int32)
        self.ranks = np.array([x[2] for x in pairs], np.int32)
        single = [(ord(p), i) for p, i in pieces.items() if len(p) == 1]
        code = np.arange(0x110000)
        utf8 = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        self.symbol = (self.size + utf8).astype(np.int32)  # size + k: no piece, k bytes
        self.symbol[[c for c, _ in single]] = [i for _, i in single]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or none) and joined piece of each pair of symbols."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == self.keys.size] = 0
        ok = (self.keys[at] == key) & (left < self.size) & (right < self.size)
        return np.where(ok, self.ranks[at], _NONE), self.joined[at]

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token (non-empty strings, blanks already as the space mark)."""
        length = np.array([len(w) for w in words], np.int64)
        sym = self.symbol[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        seq = np.repeat(np.arange(length.size), length)
        out = np.zeros(length.size, np.int64)
        rank, joined = self._pairs(sym, seq)
        while sym.size:
            start = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            least = np.minimum.reduceat(rank, start)
            if (least == _NONE).any():  # these sequences are done
                stay = np.repeat(least != _NONE, np.diff(np.r_[start, seq.size]))
                cost = np.where(sym < self.size, 1, sym - self.size)[~stay]
                out += np.bincount(seq[~stay], cost, minlength=out.size).astype(np.int64)
                sym, seq, rank, joined = sym[stay], seq[stay], rank[stay], joined[stay]
                if not sym.size:
                    break
                start = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
                least = least[least != _NONE]
            at = self._chosen(sym, seq, rank, joined, start, least)
            sym[at] = joined[at]
            keep = np.ones(sym.size, bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            at = moved[at]
            sym, seq, rank, joined = sym[keep], seq[keep], rank[keep], joined[keep]
            redo = np.unique(np.r_[at, at[at > 0] - 1])
            rank[redo], joined[redo] = self._pairs_at(sym, seq, redo)
        return out

    def _pairs(self, sym: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._pairs_at(sym, seq, np.arange(sym.size))

    def _pairs_at(self, sym: np.ndarray, seq: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined piece of the pairs that begin at ``at``; none at a sequence's end."""
        nxt = np.minimum(at + 1, sym.size - 1)
        rank, joined = self.look_up(sym[at], sym[nxt])
        rank = np.where((nxt != at) & (seq[nxt] == seq[at]), rank, _NONE)
        return rank.astype(np.int32), joined.astype(np.int32)

    def _chosen(self, sym, seq, rank, joined, start, least) -> np.ndarray:
        """Where each sequence merges now: all places of its lowest rank that do not overlap.

        One place at a time, left to right, is the defining order. Taking a sequence's places
        together gives the same unless a merge opens a pair of lower rank on the way; such a
        sequence only takes its first place in this step.
        """
        length = np.diff(np.r_[start, seq.size])
        hit = rank == np.repeat(least, length)
        at = np.flatnonzero(hit)
        new_run = np.r_[True, np.diff(at) != 1]
        run = np.cumsum(new_run) - 1
        at = at[(at - at[new_run][run]) % 2 == 0]
        own = seq[at]
        first = np.r_[True, own[1:] != own[:-1]]
        many = np.r_[~first[1:], False] | ~first
        if many.any():
            x = at[many]
            row, low, mid = seq[x], rank[x], joined[x]
            before, after = np.maximum(x - 1, 0), np.minimum(x + 2, sym.size - 1)
            has_before, has_after = (before != x) & (seq[before] == row), (after != x) & (after > x + 1) & (seq[after] == row)
            next_joined = has_after & np.isin(after, x)
            prev_joined = np.isin(x - 2, x) & (x >= 2) & (seq[np.maximum(x - 2, 0)] == row)
            lowest = np.full(x.size, _NONE)
            tries = ((sym[before], mid, has_before), (mid, sym[after], has_after), (mid, joined[after], next_joined), (joined[np.maximum(x - 2, 0)], mid, prev_joined))
            for a, b, ok in tries:
                r, _ = self.look_up(a, b)
                lowest = np.minimum(lowest, np.where(ok, r, _NONE))
            bad = np.unique(row[lowest < low])
            if bad.size:
                at = at[first | ~np.isin(own, bad)]
        return at


def _cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin: at a text's start, before a run of blanks, around line ends."""
    blank, line = raw == 0x20, raw == 0x0A
    cut = np.zeros(raw.size, bool)
    cut[1:] = (blank[1:] & ~blank[:-1]) | line[1:] | line[:-1]
    cut[offsets[offsets < raw.size]] = True
    return np.flatnonzero(cut)


def _counter(table):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merges: MergeTable = table.value
        known, counts = Known(), []
        mark, lead = SPACE.encode(), b" " if merges.dummy_space else b""

        def add(raw: bytes):
            def told(start: np.ndarray, end: np.ndarray) -> None:
                words = [raw[a:b].decode("utf-8", "replace").replace(" ", SPACE) for a, b in zip(start.tolist(), end.tolist())]
                counts.append(merges.count(words))

            return told

        for batch in batches:
            total = np.zeros(len(batch), np.int64)
            size = np.array([len(x) if x else 0 for x in batch["text"]], np.int64)
            for at, run in buffers(batch["text"]):
                # The space mark itself reads as a blank; a non-empty text begins with one.
                run = [lead + x.replace(mark, b" ") if x else b"" for x in run]
                joined = b"".join(run)
                raw = np.frombuffer(joined, np.uint8)
                if not raw.size:
                    continue
                length = np.array([len(x) for x in run], np.int64)
                offsets = np.r_[0, np.cumsum(length)][:-1]
                start = _cuts(raw, offsets)
                place = known.look_up(raw, start, np.r_[start[1:], raw.size], add(joined))
                counts = [np.concatenate(counts)]
                owner = np.searchsorted(offsets, start, "right") - 1
                total[at : at + len(run)] += np.bincount(owner, counts[0][place], minlength=len(run)).astype(np.int64)
                if known.full():
                    known.reset()
                    counts = []
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": size, "n_tokens": total})

    return run


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes (UTF-8), n_tokens, over_limit (> limit).

    Counts are those of sentencepiece's encode for the model file, without begin or end marks.
    Null and empty texts have 0 bytes and tokens. One row per input row, in no shuffle; ids
    pass through unread (null stays null) and other columns are ignored. A very long text is a
    buffer of its own. The pair table is bounded by the vocabulary and is broadcast.
    """
    with open(model_path, "rb") as f:
        table = Shared(docs.sparkSession, MergeTable(f.read()))
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counted = rows.mapInPandas(_counter(table), "doc_id string, n_bytes long, n_tokens long")
    return counted.select(F.col("doc_id").cast("long").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
