"""Token ids in packed matrices: best-fit decreasing with a segment tree over free room.

Texts become ids of a byte-level BPE vocabulary whose file is a parameter and which is broadcast.
A document's ids end with the end-of-text id. A document longer than a row is split into pieces of a
whole row and a rest, losslessly: a piece knows its document, its place and whether it is the last.

Packing works on runs of about ``run_tokens`` ids as they stream by: pieces are taken in falling
length, and each goes to the row with the least room that still fits it. Rows are leaves of a segment
tree indexed by room (one leaf per amount of room, holding how many rows have it), so the search
descends from the root to the first leaf at or right of the needed room. Nothing is shuffled or
gathered: a task holds one run, a very long document only lengthens its run by its own ids.

One output row is one matrix row: ``ids`` (little-endian, 2 or 4 bytes each, padded with the end id to
``length``), ``cu_seqlens`` (cumulative segment lengths from 0), ``position_ids`` (same layout as ids,
starting anew in each segment), and per segment doc_id, piece number and last flag.

Runs of more than ``BLANKS`` blanks are coded in parts of that many, so their ids may differ from those of the run coded at once;
they decode to the same text.

Nulls: a null or empty text is just the end id; a null doc_id stays null in its segments. Repeated rows are packed each.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import table

LENGTH, RUN_TOKENS = 2048, 2_000_000
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: that vocabulary's pre-token pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Blanks in a row that are coded at once; the pattern looks ahead from each blank of a run, on the coder's stack.
BLANKS = 50_000
_LONG_BLANKS = re.compile(rf"\s{{{BLANKS + 1},}}")


def parts(text: str) -> list[str]:
    """The text cut within runs of more than ``BLANKS`` blanks, so that none of its parts holds such a run."""
    cuts = [0]
    for run in _LONG_BLANKS.finditer(text):
        cuts += range(run.start() + BLANKS, run.end(), BLANKS)
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


class Encoder:
    """Byte-level BPE built from its ranks where it is first used, so only the ranks travel."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.end, self.model = ranks, len(ranks), None

    def __getstate__(self):
        return {"ranks": self.ranks, "end": self.end, "model": None}

    def __call__(self, text: str | None) -> np.ndarray:
        """Ids of the text and the end id."""
        if self.model is None:
            import tiktoken
            self.model = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        ids = [np.array(self.model.encode_ordinary(p), np.uint32) for p in parts(text or "")]
        return np.concatenate([*ids, np.array([self.end], np.uint32)])


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """A vocabulary file on the driver: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Room:
    """Segment tree over amounts of room: each node counts the rows below it."""

    def __init__(self, length: int):
        self.size = 1
        while self.size < length + 1:
            self.size *= 2
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.size
        while node:
            self.count[node] += 1
            node //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of a row with the least room of at least ``need``, taken out; None if there is none."""
        node, count = need + self.size, self.count
        if need >= self.size:
            return None
        while not count[node]:
            while node & 1:  # a right child: nothing to its right below its parent
                node //= 2
                if node <= 1:
                    return None
            node += 1
        while node < self.size:
            node *= 2
            if not count[node]:
                node += 1
        room = node - self.size
        while node:
            count[node] -= 1
            node //= 2
        return room, self.rows[room].pop()


def best_fit(lengths: np.ndarray, length: int) -> list[list[int]]:
    """Pieces per row, by best fit in falling length (earlier piece first among equals)."""
    room, rows = Room(length), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = room.take(n)
        if found is None:
            left, row = length, len(rows)
            rows.append([])
        else:
            left, row = found
        rows[row].append(i)
        if left > n:
            room.add(left - n, row)
    return rows


SCHEMA = ("ids binary, cu_seqlens array<int>, position_ids binary, doc_ids array<long>, pieces array<int>, last array<boolean>")


def pack(documents: DataFrame, ranks: dict[bytes, int], length: int = LENGTH, run_tokens: int = RUN_TOKENS) -> DataFrame:
    """Packed matrix rows of all texts, see the module's text for the columns."""
    sent = documents.sparkSession.sparkContext.broadcast(Encoder(ranks))
    kind = "<u2" if len(ranks) < 1 << 16 else "<u4"

    def flush(segments):
        lengths = np.array([len(s[0]) for s in segments], np.int64)
        out = {n: [] for n in ("ids", "cu_seqlens", "position_ids", "doc_ids", "pieces", "last")}
        end = sent.value.end
        for row in best_fit(lengths, length):
            chosen = [segments[i] for i in row]
            cu = np.concatenate([[0], np.cumsum(lengths[row])])
            ids = np.full(length, end, kind)
            ids[:cu[-1]] = np.concatenate([s[0] for s in chosen])
            spread = np.arange(length) - np.repeat(np.append(cu[:-1], cu[-1]), np.append(lengths[row], length - cu[-1]))
            out["ids"].append(ids.tobytes())
            out["cu_seqlens"].append(cu.tolist())
            out["position_ids"].append(spread.astype(kind).tobytes())
            for n, j in (("doc_ids", 1), ("pieces", 2), ("last", 3)):
                out[n].append([s[j] for s in chosen])
        for i in range(0, len(out["ids"]), 512):
            yield pa.RecordBatch.from_pydict({n: v[i:i + 512] for n, v in out.items()}, schema=pa.schema([
                ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("position_ids", pa.binary()),
                ("doc_ids", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32())), ("last", pa.list_(pa.bool_()))]))

    def rows(batches):
        encoder, segments, size = sent.value, [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder(text.as_py())
                for i in range(0, len(ids), length):
                    segments.append((ids[i:i + length], doc_id, i // length, i + length >= len(ids)))
                size += len(ids)
                if size >= run_tokens:
                    yield from flush(segments)
                    segments, size = [], 0
        if segments:
            yield from flush(segments)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, SCHEMA)


def unpacked(packed: DataFrame, width: int = 2) -> DataFrame:
    """Back to whole documents: doc_id, ids (4 bytes each, without the end id), one row per document id."""
    def segments(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, cu = np.frombuffer(r["ids"], f"<u{width}").astype("<u4"), r["cu_seqlens"]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": r["doc_ids"], "piece": r["pieces"],
                    "ids": [ids[a:b - (1 if z else 0)].tobytes() for a, b, z in zip(cu, cu[1:], r["last"])]},
                    schema=pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("ids", pa.binary())]))

    parts = packed.mapInArrow(segments, "doc_id long, piece int, ids binary")
    return parts.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("_p")).select(
        "doc_id", F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def write_matrices(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet, a file's rows being one id matrix with its lengths and resets."""
    packed.write.parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), read_ranks())
