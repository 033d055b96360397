"""Packing tokenized documents into sequences of a fixed length by bin completion.

One pass tokenizes the texts and writes a narrow row per piece. Lengths are whole numbers up
to the sequence length, so the search runs on their histogram, whose size does not depend on
the corpus; its fillings say for the k-th piece of each length where it goes. The k is a
distributed count: pieces are numbered inside their input partition while they are made, and
offsets per (length, partition) are added. No piece is moved through the driver.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bin_completion import pack
from .common import Shared, stored
from .ragged import Known, buffers, ranges


class ByteBpe:
    """Ids of a byte-level BPE file of the tokenizers library.

    Distinct pre-tokens are encoded once; texts that hold an added token's string go to the
    library whole. The file's ids must follow its merge order, as they do in such files.
    """

    def __init__(self, file: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(file)
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError("only byte-level BPE without normalizer is supported")
        self.library = Tokenizer.from_str(file.decode())
        self.added = [x["content"].encode() for x in spec["added_tokens"]]
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token.encode() not in self.added}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: byte-level pre-tokens
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.width[i] = len(token)
        self.known = Known()
        self.reset()

    def reset(self) -> None:
        self.known.reset()
        self.ids, self.first, self.length = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        """Ids of new pre-token runs. Runs that begin blank and end otherwise are encoded as one text."""
        gap = b" \t\n\r\x0b\x0c"
        is_clean = np.array([w[0] in gap and 0x20 < w[-1] < 0x7F for w in words])
        clean = [w for w, ok in zip(words, is_clean) if ok]
        ids = np.array(self.fast.encode_ordinary(b"".join(clean).decode()), np.int64)
        cuts = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(w) for w in clean]), "left") + 1
        rest = [self.fast.encode_ordinary(w.decode()) for w, ok in zip(words, is_clean) if not ok]
        length = np.empty(len(words), np.int64)
        length[is_clean] = np.diff(np.r_[0, cuts])
        length[~is_clean] = [len(x) for x in rest]
        first = np.empty(len(words), np.int64)
        first[is_clean] = np.r_[0, cuts][:-1]
        first[~is_clean] = ids.size + np.cumsum(length[~is_clean]) - length[~is_clean]
        self.first = np.r_[self.first, self.ids.size + first]
        self.length = np.r_[self.length, length]
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32), *(np.array(x, np.uint32) for x in rest)])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        odd = {i: np.array(self.library.encode(x.decode(), add_special_tokens=False).ids, np.uint32) for i, x in enumerate(texts) if any(a in x for a in self.added)}
        joined = b"".join(b"" if i in odd else x for i, x in enumerate(texts))
        raw = np.frombuffer(joined, np.uint8)
        if not raw.size:
            return [odd.get(i, np.empty(0, np.uint32)) for i in range(len(texts))]
        size = np.array([0 if i in odd else len(x) for i, x in enumerate(texts)], np.int64)
        offsets = np.cumsum(size) - size
        start = _runs(raw, offsets)
        end = np.r_[start[1:], raw.size]
        place = self.known.look_up(raw, start, end, lambda a, b: self._learn([joined[x:y] for x, y in zip(a.tolist(), b.tolist())]))
        length = self.length[place]
        ids = self.ids[ranges(self.first[place], length)]
        before = np.r_[0, np.cumsum(length)]
        cut = before[np.searchsorted(start, offsets, "left")]
        out = np.split(ids, cut[1:])
        if self.known.full():
            self.reset()
        return [odd.get(i, x) for i, x in enumerate(out)]


def _runs(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where runs begin: at a text's start and at ASCII white space after a sure non-space.

    After a three-byte character that might be white space there is no cut: runs only get longer.
    """
    gap = (raw == 0x20) | ((raw >= 9) & (raw <= 13))
    ok = np.zeros(raw.size, bool)
    prev = raw[:-1]
    ok[1:] = gap[1:] & ~gap[:-1]
    wide = (raw >= 0xE1) & (raw <= 0xE3)
    ok[3:] &= ~wide[:-3]
    ok[2:] &= ~((raw[:-2] == 0xC2) & ((prev[1:] == 0x85) | (prev[1:] == 0xA0)))
    ok[offsets[offsets < raw.size]] = True
    return np.flatnonzero(ok)


_PIECE = "doc_id string, piece int, start long, length int, ids_crc32 long, part int, nth long"


def _pieces(file, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, part = ByteBpe(file.value), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            ids_col, out = batch["doc_id"].tolist(), []
            for at, texts in buffers(batch["text"]):
                for i, ids in enumerate(coder.encode(texts)):
                    ids = np.append(ids, end).astype("<u4")
                    head = (ids.size - 1) % capacity + 1
                    cuts = [0, *range(head, ids.size + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        body = ids[a:b].tobytes()
                        out.append((ids_col[at + i], k, a, b - a, zlib.crc32(body), part, *([body] if with_ids else [])))
            rows = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", *(["ids"] if with_ids else [])])
            length = rows["length"].to_numpy()
            rows["nth"] = seen[length] + rows.groupby("length").cumcount().to_numpy()
            seen += np.bincount(length, minlength=capacity + 1)
            yield rows[["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", *(["ids"] if with_ids else [])]]

    return run


class Layout:
    """Where the k-th piece of each length goes, from fillings and their uses."""

    def __init__(self, solution, capacity: int) -> None:
        rows, used, base = [], np.zeros(capacity + 1, np.int64), 0
        for filling, bins in solution:
            offset = 0
            for size, each in filling:
                rows.append((size, used[size], each, base, offset))
                used[size] += bins * each
                offset += size * each
            base += bins
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.size, self.begin, self.each, self.base, self.offset = table.T
        self.scale = np.int64(max(1, used.max(initial=0)) + 1)
        self.key = self.size * self.scale + self.begin

    def place(self, length: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence number and offset of the k-th pieces of the lengths."""
        at = np.searchsorted(self.key, length * self.scale + k, "right") - 1
        t = k - self.begin[at]
        return self.base[at] + t // self.each[at], self.offset[at] + (t % self.each[at]) * length


def _placed(layout):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            where, offset = layout.value.place(batch["length"].to_numpy(np.int64), batch.pop("k").to_numpy(np.int64))
            yield batch.assign(sequence_id=where, offset=offset)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False, nodes: int = 3000) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into as few sequences of ``capacity`` tokens as it can.

    A document is its ids and ``end_id``; only longer ones are cut, from the end, into pieces of
    ``capacity``, so only the first may be shorter. Returns a row per piece: doc_id, piece,
    start, length, ids_crc32 (little-endian 32-bit ids), sequence_id, offset; with ``with_ids``
    also ids (binary, the same bytes). Offsets of a sequence leave no gap. Null and empty texts
    are just ``end_id``. Repeated rows and ids are separate documents; null ids stay null.
    Other columns are ignored. An empty table gives no rows. The histogram (at most
    ``capacity`` rows) is all that reaches the driver.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        file = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    schema = _PIECE + (", ids binary" if with_ids else "")
    pieces = stored(rows.mapInPandas(_pieces(file, capacity, end_id, with_ids), schema), "pieces")

    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    layout = Shared(spark, Layout(pack(counts, capacity, nodes=nodes), capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("k", F.col("base") + F.col("nth"))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    kept_schema = "doc_id string, piece int, start long, length int, ids_crc32 long, " + ("ids binary, " if with_ids else "") + "sequence_id long, offset long"
    placed = ranked.select(*keep, "k").mapInPandas(_placed(layout), kept_schema)
    return placed.withColumns({"doc_id": F.col("doc_id").cast("long"), "length": F.col("length").cast("long")})


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens, ids (binary), from pieces with ids.

    A sequence holds at most ``capacity`` tokens, so each group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return whole.select("sequence_id", "n_tokens", joined.alias("ids"))
