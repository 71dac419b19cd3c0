"""Document fingerprints: a Merkle tree over sections, paragraphs and short pieces.

A text splits after each line break into paragraphs, and a blank line ends a section. A paragraph
splits further after blanks chosen by the three bytes up to them, four words or so apart, so that an
edit changes only the pieces it touches; the first 64 bytes of a text split at each blank, and a stretch
without a chosen blank (repeated words) every 32 bytes or so. A piece's digest covers its bytes; a paragraph's, a section's
and the root's cover the digests below, so equal roots mean equal texts, and comparing branches from
the root down locates the pieces that differ.

A fingerprint is text: the root (32 hex digits), a colon, and the whole tree with digests shortened to six
characters (36 bits): sections parted by semicolons, each its digest and then its paragraphs, parted by commas,
each its digest and then its pieces. Likeness of two fingerprints is
1 for equal roots, else the pieces they share (with repeats) over the larger number of pieces. Two different
pieces look equal once in 2**36, so unrelated texts of n pieces each have a likeness near n / 2**36 by chance
(6e-7 at 1 MB, 6e-5 at 100 MB), and ``edits`` misses a changed branch once in 2**36.

The comparison with the next document needs neighbours by falling id. Ids alone give quantile bounds
and each range's first id, one number per range and at most ``RANGES`` in all: beyond that ranges grow, which
costs no memory, as tasks stream over their sorted rows. Texts are then shuffled once by range, into as many tasks as
the session has shuffle partitions, or more where these would exceed ``TASK_CHARS`` each; a range's
first document is also sent to the range before it, so each task meets its rows in order, with
their successor, and holds two texts at a time. Rows with equal ids are one range.

Nulls and ties: null and empty texts are equal and have no pieces; a null id comes last; rows with
equal ids follow their texts; a single row is its own next.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import table, utf8

RANGE_CHARS, TASK_CHARS, RANGES, FINE_BYTES = 4_000_000, 64_000_000, 20_000, 64
#: Characters of a shortened digest, of six bits each.
SHORT = 6


def _digest(data: bytes, size: int = 8) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def tree(text: str | None) -> tuple[bytes, list[tuple[bytes, list[tuple[bytes, list[bytes]]]]]]:
    """Root digest, and by section its digest and its paragraphs, each a digest and those of its pieces."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return _digest(b"r", 16), []
    raw = np.frombuffer(b"\0\0\0" + data, np.uint8)
    blank = np.where((raw[3:] == 32) | (raw[3:] == 10))[0]
    key = raw[blank].astype(np.uint32)
    for j in (1, 2):
        key = key << np.uint32(8) | raw[blank + j]
    chosen = ((key * np.uint32(2654435761)) >> np.uint32(30) == 0) | (raw[blank + 3] == 10) | (blank < FINE_BYTES)
    cuts = blank[chosen] + 1
    if not len(cuts) or cuts[-1] != len(data):
        cuts = np.append(cuts, len(data))
    for i in np.where(np.diff(cuts, prepend=0) > 3 * FINE_BYTES)[0]:  # repeated words choose no blank: cut every few
        inside = blank[(blank >= (cuts[i - 1] if i else 0)) & (blank < cuts[i] - 1)] + 1
        steps = inside // (FINE_BYTES // 2)
        chosen[np.searchsorted(blank, inside[np.diff(steps, prepend=-1) > 0] - 1)] = True
    cuts = sorted({*(blank[chosen] + 1).tolist(), len(data)})
    sections, paragraph, start = [[]], [], 0
    for end in cuts:
        piece = data[start:end]
        paragraph.append(_digest(piece))
        if piece[-1] == 10:
            sections[-1].append(paragraph)
            if piece == b"\n" and len(paragraph) == 1:
                sections.append([])
            paragraph = []
        start = end
    if paragraph:
        sections[-1].append(paragraph)
    if not sections[-1]:
        sections.pop()
    inner = []
    for section in sections:
        paragraphs = [(_digest(b"p" + b"".join(p)), p) for p in section]
        inner.append((_digest(b"s" + b"".join(d for d, _ in paragraphs)), paragraphs))
    return _digest(b"r" + b"".join(d for d, _ in inner), 16), inner


def _short(piece: bytes) -> str:
    return base64.b64encode(piece)[:SHORT].decode()


def fingerprint(text: str | None) -> str:
    root, sections = tree(text)
    return root.hex() + ":" + ";".join(
        _short(d) + ",".join(_short(e) + "".join(map(_short, p)) for e, p in paragraphs) for d, paragraphs in sections)


def branches(print_: str) -> list[tuple[str, list[str]]]:
    """By section its digest and its paragraphs, each the digest followed by the pieces."""
    return [(s[:SHORT], s[SHORT:].split(",")) for s in print_[33:].split(";")] if print_[33:] else []


def pieces(print_: str) -> list[str]:
    body = "".join(p[SHORT:] for _, paragraphs in branches(print_) for p in paragraphs)
    return [body[i:i + SHORT] for i in range(0, len(body), SHORT)]


def likeness(a: str, b: str, of_a: Counter | None = None, of_b: Counter | None = None) -> float:
    if a[:32] == b[:32]:
        return 1.0
    x, y = of_a if of_a is not None else Counter(pieces(a)), of_b if of_b is not None else Counter(pieces(b))
    most = max(x.total(), y.total())
    if len(y) < len(x):
        x, y = y, x
    return sum(min(n, y.get(p, 0)) for p, n in x.items()) / most if most else 0.0


def aligned(a: list[str], b: list[str]) -> list[tuple[int, int, int, int]]:
    """Stretches (from, to of a, from, to of b) that differ, equal branches being aligned in order."""
    return [m[1:] for m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if m[0] != "equal"]


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of the branches of ``b`` that ``a`` lacks there; what ``b`` lacks is ``edits(b, a)``.

    Compared from the root down: sections with equal digests are aligned and never opened, and so are
    paragraphs within the sections that differ, so what was put in or taken out marks no later branch (but for a paragraph that enters or
    leaves the text's first FINE_BYTES, which are split more finely).
    """
    if a[:32] == b[:32]:
        return []
    left, right, out = branches(a), branches(b), []
    for i, j, k, m in aligned([d for d, _ in left], [d for d, _ in right]):
        old = [p[:SHORT] for _, paragraphs in left[i:j] for p in paragraphs]
        new = [(s, n, p[:SHORT]) for s in range(k, m) for n, p in enumerate(right[s][1])]
        for _, _, h, l in aligned(old, [d for _, _, d in new]):
            out += [q[:2] for q in new[h:l]]
    return out


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint of each row; texts are only streamed."""
    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t.as_py()) for t in batch.column(1)], pa.string())],
                                             names=["doc_id", "fingerprint"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, fingerprint string")


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def compare_next(documents: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """Each document, its edit with the next one's start, and how like the fingerprints are (see OUT)."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    chars, rows = docs.agg(F.sum(F.length("text")), F.count(F.lit(1))).first()
    n = max(1, min(rows or 1, RANGES, math.ceil((chars or 0) / range_chars)))
    bounds = sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.25 / n))) if n > 1 else []
    sent = spark.sparkContext.broadcast(np.array(bounds, np.int64))

    def ranged(ids: pa.Array) -> np.ndarray:
        """Number of the range, rising with falling id; nulls are in the last."""
        lowest = np.iinfo(np.int64).min
        values = ids.fill_null(lowest).to_numpy(zero_copy_only=False)
        return len(sent.value) - np.searchsorted(sent.value, values, side="right")

    def tops(batches):
        best: dict[int, tuple[bool, int]] = {}
        for batch in batches:
            for r, i in zip(ranged(batch.column(0)).tolist(), batch.column(0).to_pylist()):
                mine = (i is not None, i or 0)
                best[r] = max(best.get(r, mine), mine)
        yield pa.RecordBatch.from_pydict({"r": list(best), "known": [v[0] for v in best.values()], "id": [v[1] for v in best.values()]},
                                         schema=pa.schema([("r", pa.int64()), ("known", pa.bool_()), ("id", pa.int64())]))

    found = docs.select("doc_id").mapInArrow(tops, "r long, known boolean, id long").groupBy("r").agg(
        F.max(F.struct("known", "id")).alias("top")).collect()  # one row per range
    first = {r: (t["known"], t["id"]) for r, t in found}
    order = sorted(first)
    before = {first[r]: order[i - 1] for i, r in enumerate(order)}  # the first range comes after the last
    heads = spark.sparkContext.broadcast(before)

    def dealt(batches):
        known = heads.value
        for batch in batches:
            r = ranged(batch.column(0))
            key = [(i is not None, i or 0) for i in batch.column(0).to_pylist()]
            extra = [j for j, k in enumerate(key) if k in known]
            take = pa.array(list(range(len(key))) + extra, pa.int64())
            whole = batch.take(take)
            to = np.concatenate([r, [known[key[j]] for j in extra]]).astype(np.int64)
            for i in range(0, len(to), 2000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[i:i + 2000]), pa.array(np.arange(i, min(i + 2000, len(to))) >= len(key)), *(c.slice(i, 2000) for c in whole.columns)],
                    names=["r", "head", "doc_id", "text"])

    placed = docs.mapInArrow(dealt, "r long, head boolean, doc_id long, text string")
    by_size = math.ceil((chars or 0) / TASK_CHARS)
    width = max(1, min(len(order), max(by_size, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    lined = placed.repartition(width, "r").sortWithinPartitions("r", "head", F.col("doc_id").desc_nulls_last(), "text")

    def compared(batches):
        kinds = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
        out, now = {f.name: [] for f in kinds}, None
        for batch in batches:
            for r, head, doc_id, text in zip(*(batch.column(i) for i in range(4))):
                r, head, doc_id, text = r.as_py(), head.as_py(), doc_id.as_py(), text.as_py()
                mine = fingerprint(text)
                new = (r, doc_id, text, mine, Counter(pieces(mine)))
                if now is not None and now[0] == r:
                    _, d, t, f, c = now
                    half = len(t) // 2
                    edited = t[:len(t) - half] + text[:half]
                    g = fingerprint(edited)
                    for name, v in zip(out, (d, len(t), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), f, g,
                                             likeness(f, g, c), likeness(f, mine, c, new[4]))):
                        out[name].append(v)
                    if len(out["doc_id"]) >= 1000:
                        yield pa.RecordBatch.from_pydict(out, schema=kinds)
                        out = {f.name: [] for f in kinds}
                now = None if head else new  # a further head of this range is no document here
                if head:
                    now = (-1, None, "", "", Counter())
        yield pa.RecordBatch.from_pydict(out, schema=kinds)

    return lined.mapInArrow(compared, OUT)


def query(spark, sf_dir: str) -> DataFrame:
    return compare_next(table(spark, sf_dir, "documents"))
