"""Fill-in-the-middle: texts cut at two units and put together as prefix, suffix, middle.

A unit is a run of ASCII letters or any other single code point. A text's UTF-8 bytes fall into fixed blocks;
a Fenwick tree over the blocks holds, per block, how many units and how many code points begin in it. The place
of the k-th unit is found by a binary-lifting descent from the largest step down, which ends at the block in which
that unit begins and has summed the code points before it; only that block is then looked at byte by
byte. So beyond one pass that counts, a cut costs the tree's height and one block, however long the text.
Counting runs over ``STRIP`` blocks at a time, so a task holds one text and masks of a strip.

Where a document is cut, and in which form it is given out, hangs on four numbers drawn from the sha256 of a seed
and its id alone, so reruns and other partitionings agree. Forms: ``plain`` (the text as it is: empty
texts, texts that hold a marker, and a share ``1 - rate``), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix first). A
text that holds no marker is rebuilt exactly from output and form, since a marker begins with its only ``<`` and
so can't straddle the end of a part.

Nulls and ties: a null text counts as empty; a null id is drawn for as empty text (``1:``) and stays null; repeated
rows each come out, alike; other columns, whatever their names, are not read. Very long texts are cut whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import pieces, table, utf8

BLOCK, STRIP = 1024, 1024
#: Markers ahead of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Bytes that begin a code point: all but continuations.
_LEAD = (np.arange(256) & 0xC0) != 0x80


def begins(data: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the bytes that begin a unit and that begin a code point; ``before`` is the byte ahead of them."""
    letter, lead = _LETTER[data], _LEAD[data]
    follows = np.empty(len(data), bool)
    follows[:1] = _LETTER[before]
    follows[1:] = letter[:-1]
    return lead & ~(letter & follows), lead


class BlockIndex:
    """Fenwick tree over the blocks of one text, with counts of units and code points."""

    def __init__(self, data: bytes, block: int = BLOCK, strip: int = STRIP):
        self.data, self.block = np.frombuffer(data, np.uint8), block
        size = len(self.data)
        blocks = -(-size // block)
        counts = np.zeros((blocks, 2), np.int64)
        for first in range(0, blocks, strip):
            low, high = first * block, min((first + strip) * block, size)
            starts = np.arange(0, high - low, block)
            for i, mask in enumerate(begins(self.data[low:high], self._ahead(low))):
                counts[first:first + len(starts), i] = np.add.reduceat(mask, starts, dtype=np.int64)
        self.units, self.points = (int(x) for x in counts.sum(axis=0))
        # A node at i (from 1) covers the i & -i blocks up to i: a difference of running sums.
        node = np.arange(1, blocks + 1)
        sums = np.concatenate([np.zeros((1, 2), np.int64), counts.cumsum(axis=0)])
        self.tree = np.concatenate([sums[:1], sums[node] - sums[node - (node & -node)]])
        self.top = 1 << blocks.bit_length() >> 1

    def _ahead(self, byte: int) -> int:
        return int(self.data[byte - 1]) if byte else 0

    def add(self, block: int, units: int, points: int) -> None:
        """Count a change to a block in all nodes that cover it."""
        i = block + 1
        while i < len(self.tree):
            self.tree[i] += (units, points)
            i += i & -i

    def cut(self, k: int) -> tuple[int, int]:
        """(byte, code point) at which unit ``k`` (from 0) begins, or the text's end if it has no more than ``k``."""
        if k >= self.units:
            return len(self.data), self.points
        at, left, points, step = 0, k, 0, self.top
        while step:
            if at + step < len(self.tree) and self.tree[at + step, 0] <= left:
                at += step
                left -= int(self.tree[at, 0])
                points += int(self.tree[at, 1])
            step >>= 1
        low = at * self.block
        unit, point = begins(self.data[low:low + self.block], self._ahead(low))
        inside = int(np.flatnonzero(unit)[left])
        return low + inside, points + int(np.count_nonzero(point[:inside]))


def draws(doc_id: int | None, seed: int = 1) -> list[int]:
    """Four numbers of 32 bits from seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def transformed(text: bytes, doc_id: int | None, seed: int = 1, rate: int = 90, spm: int = 20):
    """(units, form, code points of the prefix, of the middle, output); the code points are None where form is plain."""
    index = BlockIndex(text)
    n, (h1, h2, h3, h4) = index.units, draws(doc_id, seed)
    if not text or h3 % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    (a, points_a), (b, points_b) = (index.cut(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    parts = (PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b])
    form = "spm" if h4 % 100 < spm else "psm"
    if form == "spm":
        parts = parts[2:4] + parts[:2] + parts[4:]
    return n, form, points_a, points_b - points_a, b"".join(parts)


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                    ("middle_chars", pa.int64()), ("output", pa.binary())])


def transform(documents: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20) -> DataFrame:
    """Every row's output text with its form and cuts; ``rate`` per cent are cut, ``spm`` per cent of these suffix first."""
    def rows(batches):
        for batch in batches:
            for ids, texts in pieces(batch):
                made = [(i, *transformed(t or b"", i, seed, rate, spm)) for i, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), _ARROW)], schema=_ARROW)

    made = documents.select(F.col("doc_id").cast("long"), utf8(F.col("text"))).mapInArrow(rows, SCHEMA)
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, from output and form alone: built-in functions only."""
    def between(after: str | None, before: str) -> Column:
        rest = F.substring_index(output, after, -1) if after else F.substring(output, len(PREFIX) + 1, F.length(output))
        return F.substring_index(rest, before, 1)

    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))
    middle = F.substring_index(output, m, -1)
    return (F.when(form == "plain", output).when(form == "psm", F.concat(between(None, s), middle, between(s, m)))
            .otherwise(F.concat(between(p, m), middle, between(None, p))))


def query(spark, sf_dir: str) -> DataFrame:
    made = transform(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = """
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
    SELECT *, len(units) AS n, ('0x' || h[1:8])::UBIGINT % (len(units) + 1) AS c1, ('0x' || h[9:16])::UBIGINT % (len(units) + 1) AS c2,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR ('0x' || h[17:24])::UBIGINT % 100 >= 90 THEN 'plain'
                WHEN ('0x' || h[25:32])::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
    SELECT *, array_to_string(units[1:least(c1, c2)], '') AS prefix,
           array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
           array_to_string(units[greatest(c1, c2) + 1:], '') AS suffix FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
