"""Language-model scores by context-tree weighting over bytes.

A text is its lower-cased words, each ended by a blank, and then one end mark. Each byte is eight binary
decisions, predicted from up to ``DEPTH`` bytes before it in the running text, across words; an end mark and
then zeros stand ahead of a text. Every context depth holds, for each decision, Krichevsky-Trofimov counts from the training texts. A node's
weighted probability is half its own estimate plus half the product over its longer contexts,
bottom-up, and a prediction mixes the estimates along the path with the weights that follow; where a
longer context was never met, the path ends. Probabilities of all texts thus sum to one.

Work is laid out by distinct things, never by token:
1. Texts are shuffled into chunks of about ``CHUNK_CHARS`` characters. Each chunk gives its distinct words, and
   its distinct contexts with the byte that follows, with their training counts. Contexts are dealt into buckets by their last
   three bytes; a chunk's keys of a bucket are one packed row of sorted differences, a byte and a half or so each.
2. Words are dealt into buckets, packed and summed alike. Each bucket of contexts is merged into one row: distinct keys, summed counts, and
   each chunk's positions among them. A bucket holds whole subtrees of three-byte contexts and sums them up for those of two
   bytes, which are added up by part (last two bytes); a part sums up for contexts of one byte, and of these at most 256 x 255 rows reach the driver.
3. Each bucket then gives its contexts' log-probabilities, and each chunk gets its own as packed single-precision
   numbers in the order of its keys, which it makes anew from its texts: no key travels back, and no key is joined.

Buckets grow in number with the corpus, so that each stays at a few million keys at most; what can't be split is the
contexts that share their last three bytes.

Nulls: a null text is empty and is just the end mark. Repeated rows count and are scored each. Without training
texts every decision has probability one half.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import drop_staged, held_out, mix64, staged, table, utf8, words

DEPTH, CHUNK_CHARS, RUN_BYTES = 7, 8_000_000, 1 << 20
END = b"\n"
#: What stands ahead of a text.
START = bytes(DEPTH - 1) + END
LOG10 = math.log(10)


def coded(text: bytes | None) -> bytes:
    found = words(text)
    return b" ".join(found) + b" " + END if found else END


def running(texts: list[bytes | None], size: int = RUN_BYTES, code=coded):
    """(number of its text, context and byte as one number) of every byte, in runs of about ``size`` bytes.

    The key fills 64 bits: the byte, and above it the ``DEPTH`` bytes before it, the nearest lowest.
    """
    def run() -> tuple[np.ndarray, np.ndarray]:
        key = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
        seen = 1  # bytes in each key so far
        while seen <= DEPTH:
            more = min(seen, DEPTH + 1 - seen)
            key[more:] |= key[:-more] << (8 * more)
            seen += more
        length = np.fromiter(map(len, parts), np.int64, len(parts))
        own = np.ones(len(key), bool)
        own[((np.cumsum(length) - length)[:, None] + np.arange(DEPTH)).ravel()] = False
        return np.repeat(np.array(numbers, np.int64), length - DEPTH), key[own]

    numbers, parts, held = [], [], 0
    for i, text in enumerate(texts):
        whole = START + code(text)
        for at in range(0, len(whole) - DEPTH, size):  # a part repeats the bytes that its first ones see
            numbers.append(i), parts.append(whole[at:at + size + DEPTH])
            held += len(parts[-1])
            if held >= size:
                yield run()
                numbers, parts, held = [], [], 0
    if parts:
        yield run()


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the sum of n of each. Keys come in sorted runs, which a stable sort merges."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    return key[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the place of each given key among them; keys come in sorted runs here too."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.append(True, key[1:] != key[:-1])[:len(key)]
    at = np.empty(len(key), np.int32)
    at[order] = np.cumsum(first, dtype=np.int32) - 1
    return key[first], at


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling series, moved up by eight; for x >= 0.5, and the better the larger."""
    shift = x.copy()
    for i in range(1, 8):
        shift *= x + i
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - np.log(shift)


#: Log gamma of small counts, plus a half and plus one; most contexts are rare.
SMALL = 4096
_AT = {plus: np.array([math.lgamma(n + plus) for n in range(SMALL)]) for plus in (0.5, 1.0)}


def _log_gamma_of(n: np.ndarray, plus: float) -> np.ndarray:
    out = _AT[plus][np.minimum(n, SMALL - 1).astype(np.int64)]
    large = n >= SMALL
    out[large] = log_gamma(n[large] + plus)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of that many zeros and ones."""
    return _log_gamma_of(zeros, 0.5) + _log_gamma_of(ones, 0.5) - _log_gamma_of(zeros + ones, 1.0) - math.log(math.pi)


def in_tree_order(key: np.ndarray) -> np.ndarray:
    """Keys with the nearest byte on top and the coded byte lowest: sorted, every subtree is one stretch."""
    x = key.astype(np.int64, copy=False).view(np.uint64).byteswap()
    return x << np.uint64(8) | x >> np.uint64(56)


class Levels:
    """Counts, weights and predictions of given contexts (key, training count) at depths ``lowest`` to DEPTH.

    A depth's names are its distinct (context, byte), sorted; a decision's nodes are runs of them. Each
    depth is made from the names of the next longer one, so that work falls with the depth.
    """

    def __init__(self, key: np.ndarray, n: np.ndarray, lowest: int = 2, ordered: bool = False):
        """``ordered``: keys are distinct, in tree order and sorted."""
        self.lowest, self.at = lowest, None
        if not ordered:
            key, self.at = np.unique(in_tree_order(key), return_inverse=True)
            n = np.bincount(self.at, n, len(key))
        prefix, byte = key >> np.uint64(8), (key & np.uint64(255)).astype(np.int64)
        number = np.cumsum(np.diff(prefix, prepend=prefix[:1]) != 0)
        self.depths = [(number << 8 | byte, None, n)]  # (names, where the names one deeper belong, counts)
        for _ in range(DEPTH - lowest):
            prefix = prefix >> np.uint64(8)
            begin = np.diff(prefix, prepend=prefix[:1]) != 0
            begin[:1] = True
            number = np.cumsum(begin) - 1
            names, to = np.unique(number << 8 | byte, return_inverse=True)
            prefix, byte, n = prefix[begin][names >> 8], names & 255, np.bincount(to, n, len(names))
            self.depths.append((names, to, n))
        self.byte = byte
        self.context = sum((prefix >> np.uint64(8 * (lowest - 1 - i)) & np.uint64(255)).astype(np.int64) << (8 * i) for i in range(lowest))

    def bit(self, bit: int) -> None:
        """Set the nodes of this decision: zeros, ones and log_w of the lowest depth's, node, first and seen by name."""
        self.nodes, below = [], None
        for names, to, count in self.depths:
            begin = np.diff(names >> (8 - bit), prepend=-1) != 0
            runs, node_of = np.flatnonzero(begin), np.cumsum(begin) - 1
            one = (names >> (7 - bit) & 1).astype(bool)
            total, ones = np.add.reduceat(count, runs), np.add.reduceat(count * one, runs)
            zeros, log_w = total - ones, None
            log_own = log_kt(zeros, ones)
            if to is None:
                log_w, log_beta = log_own, None
            else:
                deeper = np.bincount(node_of[to[below[0]]], below[1], len(runs))
                log_w, log_beta = np.logaddexp(log_own, deeper) - math.log(2), log_own - deeper
            below = (runs, log_w)
            self.nodes.append((node_of, one, zeros, ones, log_beta))
        self.first, self.log_w = below
        self.zeros, self.ones, self.seen = zeros, ones, (total > 0)[node_of]
        self.node, self.one = (1 << bit) | (self.byte >> (8 - bit)), one

    def predict(self, offset: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of each key: offset + weight * its prediction from the lowest depth down, both given by name of that depth."""
        for (_, to, _), now, deeper in zip(self.depths[:0:-1], self.nodes[:0:-1], self.nodes[-2::-1]):
            node_of, one, zeros, ones, log_beta = now
            met = ((deeper[2] + deeper[3]) > 0)[deeper[0]]
            offset, weight = shared(offset[to], weight[to], estimate(one, zeros[node_of], ones[node_of])[to], log_beta[node_of][to], met)
        node_of, one, zeros, ones, _ = self.nodes[0]
        p = offset + weight * estimate(one, zeros[node_of], ones[node_of])
        return p if self.at is None else p[self.at]


def estimate(one: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1)


def shared(offset: np.ndarray, weight: np.ndarray, own: np.ndarray, log_beta: np.ndarray, met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What is settled by a node's own estimate, and the weight left to the longer context; none where that was not met."""
    part = np.where(met, 1 / (1 + np.exp(-np.clip(log_beta, -60, 60))), 1.0)
    return offset + weight * own * part, weight * (1 - part)


NODES = "code array<long>, zeros array<double>, ones array<double>, below array<double>"


class Second:
    """Nodes of contexts of two bytes (code: context, then node), from the sums over their longer ones."""

    def __init__(self, code, zeros, ones, below):
        self.code, to = np.unique(np.concatenate(code), return_inverse=True)
        self.zeros, self.ones, below = (np.bincount(to, np.concatenate(x), len(self.code)) for x in (zeros, ones, below))
        own = log_kt(self.zeros, self.ones)
        self.below, self.log_beta, self.log_w = below, own - below, np.logaddexp(own, below) - math.log(2)


def sums_of_two(x: Levels) -> list[np.ndarray]:
    """Code, zeros, ones and below of the two-byte nodes of whole three-byte subtrees, over all decisions."""
    parts = []
    for bit in range(8):
        x.bit(bit)
        code, to = np.unique((x.context[x.first] & 0xFFFF) << 8 | x.node[x.first], return_inverse=True)
        parts.append([code, *(np.bincount(to, v, len(code)) for v in (x.zeros, x.ones, x.log_w))])
    return [np.concatenate(column) for column in zip(*parts)]


class Top:
    """Contexts of one byte and of none, from the summaries: dense tables over byte, node."""

    def __init__(self, rows: list):
        self.zeros, self.ones, below = (np.zeros((256, 256)) for _ in range(3))
        for r in rows:
            self.zeros[r.byte, r.node], self.ones[r.byte, r.node], below[r.byte, r.node] = r.zeros, r.ones, r.below
        own = log_kt(self.zeros, self.ones)
        self.beta1, w = own - below, np.logaddexp(own, below) - math.log(2)
        self.zeros0, self.ones0 = self.zeros.sum(axis=0), self.ones.sum(axis=0)
        self.beta0 = log_kt(self.zeros0, self.ones0) - w.sum(axis=0)

    def finish(self, x: Levels, second: Second | None = None) -> np.ndarray:
        """Predictions of the keys of ``x`` with the depths above its lowest mixed in (``second`` where that is three)."""
        byte, node = x.context & 255, x.node
        zeros, ones = self.zeros[byte, node], self.ones[byte, node]
        offset, weight = shared(np.zeros(len(node)), np.ones(len(node)), estimate(x.one, self.zeros0[node], self.ones0[node]),
                                self.beta0[node], zeros + ones > 0)
        own, log_beta = estimate(x.one, zeros, ones), self.beta1[byte, node]
        if second:
            at = np.searchsorted(second.code, (x.context & 0xFFFF) << 8 | node)
            zeros, ones = second.zeros[at], second.ones[at]
            offset, weight = shared(offset, weight, own, log_beta, zeros + ones > 0)
            own, log_beta = estimate(x.one, zeros, ones), second.log_beta[at]
        return x.predict(*shared(offset, weight, own, log_beta, x.seen))


def squeezed(x: np.ndarray) -> bytes:
    """Numbers of eight or four bytes, their bytes laid out by place, as zstd."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes())


def unsqueezed(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


def squeezed_rising(x: np.ndarray) -> bytes:
    return squeezed(np.diff(x.astype(np.uint64, copy=False), prepend=np.uint64(0)))


def unsqueezed_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueezed(data, np.uint64), dtype=np.uint64)


def chunked(documents: DataFrame, learn: Column, n: int) -> DataFrame:
    """(chunk, blob): rows of ``n`` chunks, those of a batch in one compressed stream, as texts are shuffled twice."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"), learn.alias("learn"),
                            F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("chunk"))

    def streams(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            chunk = batch.column(3).to_numpy()
            order = np.argsort(chunk, kind="stable")
            cuts = np.flatnonzero(np.diff(chunk[order], prepend=-1))
            for rows in np.split(order, cuts[1:]) if len(order) else []:
                sink = pa.BufferOutputStream()
                part = batch.select([0, 1, 2]).take(pa.array(rows))
                with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([chunk[rows[0]]], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                                 names=["chunk", "blob"])

    return docs.mapInArrow(streams, "chunk int, blob binary")


def chunk_rows(chunk: pa.Table) -> pa.Table:
    return pa.concat_tables(pa.ipc.open_stream(b.as_py()).read_all() for b in chunk.column("blob"))


SALTS = 16


def buckets_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket of each key (sorted, in tree order): by its last two bytes, and by the third one of SALTS within."""
    begin = np.flatnonzero(np.diff(keys >> np.uint64(40), prepend=np.uint64(1 << 60)))
    three = keys[begin] >> np.uint64(40)
    group = mix64(three >> np.uint64(8)) % np.uint64(n_buckets // SALTS)
    bucket = group * np.uint64(SALTS) + mix64(three) % np.uint64(SALTS)
    return np.repeat(bucket.astype(np.int32), np.diff(np.append(begin, len(keys))))


def tokens(texts: list[bytes], n_buckets: int) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Of coded texts: (text of each token, its word's number, the distinct words by bucket and then bytes, their buckets)."""
    whole = b"".join(texts)
    raw = np.frombuffer(whole, np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == 10))  # a word's blank, or an end mark, which is a token itself
    last = raw[ends] == 10
    size = np.diff(ends, prepend=-1) - 1 + last
    offsets = np.append(0, np.cumsum(size)).astype(np.int32)
    kept = whole.translate(None, b" ")
    coding = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]).dictionary_encode()
    names = coding.dictionary
    order = pc.sort_indices(names).to_numpy()
    bucket = word_buckets(names, n_buckets)
    order = order[np.argsort(bucket[order], kind="stable")]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return np.cumsum(last) - last, rank[coding.indices.to_numpy()], names.take(pa.array(order)), bucket[order]


def bytes_of(words_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of words, and where each starts (and the last one ends)."""
    _, offsets, data = words_.buffers()
    at = np.frombuffer(offsets, np.int32)[words_.offset:words_.offset + len(words_) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def word_buckets(names: pa.Array, n_buckets: int) -> np.ndarray:
    if not len(names):
        return np.zeros(0, np.int32)
    data, at = bytes_of(names)
    place = (np.arange(len(data)) - np.repeat(at[:-1], np.diff(at))).astype(np.uint64)
    return (mix64(np.add.reduceat(mix64(place << np.uint64(8) | data), at[:-1])) % np.uint64(n_buckets)).astype(np.int32)


def sorted_runs(texts: list[bytes]):
    """Of each run of bytes of coded texts: its distinct keys in tree order, how often each is there, and the texts of its bytes in that order."""
    for text, key in running(texts, code=bytes):
        key = in_tree_order(key)
        order = np.argsort(key)
        key = key[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        yield key[begin], np.diff(np.append(begin, len(key))).astype(np.int32), text[order].astype(np.int32)


def counted_runs(texts: list[bytes]):
    """Of each run of bytes of coded texts: its distinct keys in tree order, and how often each is there. Sorts the keys alone."""
    for _, key in running(texts, code=bytes):
        key = np.sort(in_tree_order(key))
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        yield key[begin], np.diff(np.append(begin, len(key)))


def stretches(bucket: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
    return list(zip(cuts[:-1], cuts[1:]))


FOUND = "chunk int, bucket int, word boolean, keys binary, sizes binary, counts binary"


def contents(chunk: pa.Table, n_buckets: int) -> pa.Table:
    """By bucket: the distinct words of a chunk, and the keys of its distinct contexts, each with their training counts."""
    docs, number = chunk_rows(chunk), chunk.column("chunk")[0].as_py()
    texts, learn = [coded(t.as_py()) for t in docs.column("text")], np.array(docs.column("learn").to_pylist(), bool).astype(np.int64)
    text, codes, names, bucket = tokens(texts, n_buckets)
    n = np.bincount(codes, learn[text], len(names)).astype(np.int64)
    del text, codes
    out = []
    for i, j in stretches(bucket):
        data, at = bytes_of(names.slice(i, j - i))
        out.append((number, int(bucket[i]), True, zstandard.compress(data.tobytes()), squeezed(np.diff(at).astype(np.int64)), squeezed(n[i:j])))
    # Texts that are learned from and others are counted apart, so no sort carries the text of each byte along.
    runs = [(key, often * kind) for kind in (1, 0) for key, often in counted_runs([t for t, own in zip(texts, learn) if own == kind])]
    keys, counts = (np.concatenate(x) for x in zip(*runs))
    del runs
    keys, counts = summed(keys, counts)
    bucket = buckets_of(keys, n_buckets)
    order = np.argsort(bucket, kind="stable")
    for i, j in stretches(bucket[order]):
        mine = order[i:j]
        out.append((number, int(bucket[mine[0]]), False, squeezed_rising(keys[mine]), None, squeezed(counts[mine])))
    kinds = (pa.int32(), pa.int32(), pa.bool_(), *[pa.binary()] * 3)
    return pa.table([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names=["chunk", "bucket", "word", "keys", "sizes", "counts"])


def merged_words(rows: pa.Table) -> pa.Table:
    """A bucket of words: for each chunk the training counts of its words, in their order; their sum, and how many are above 0."""
    sizes = [unsqueezed(x.as_py(), np.int64) for x in rows.column("sizes")]
    data = b"".join(zstandard.decompress(x.as_py()) for x in rows.column("keys"))
    offsets = np.append(0, np.cumsum(np.concatenate(sizes)))
    coding = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    codes = coding.indices.to_numpy()
    n = np.bincount(codes, np.concatenate([unsqueezed(x.as_py(), np.int64) for x in rows.column("counts")]), len(coding.dictionary)).astype(np.int64)
    each = np.split(n[codes], np.cumsum([len(x) for x in sizes])[:-1])
    return pa.table({"bucket": rows.column("bucket").slice(0, 1), "chunks": pa.array([rows.column("chunk").to_pylist()], pa.list_(pa.int32())),
                     "values": pa.array([[squeezed(x) for x in each]], pa.list_(pa.binary())),
                     "total": pa.array([float(n.sum())]), "known": pa.array([int((n > 0).sum())], pa.int64())})


def merged(rows: pa.Table) -> pa.Table:
    """A bucket as one row: its distinct keys and counts, each chunk's positions among them, and its two-byte nodes."""
    parts = [unsqueezed_rising(k.as_py()) for k in rows.column("keys")]
    counts = np.concatenate([unsqueezed(c.as_py(), np.int64) for c in rows.column("counts")])
    keys, at = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.bincount(at, counts, len(keys))
    positions = np.split(at, np.cumsum([len(p) for p in parts])[:-1])
    bucket = rows.column("bucket")[0].as_py()
    nodes = sums_of_two(Levels(keys, counts, 3, ordered=True))
    return pa.table({"bucket": pa.array([bucket], pa.int32()), "part": pa.array([bucket // SALTS], pa.int32()),
                     "keys": pa.array([squeezed_rising(keys)], pa.binary()), "counts": pa.array([squeezed(counts)], pa.binary()),
                     "chunks": pa.array([rows.column("chunk").to_pylist()], pa.list_(pa.int32())),
                     "positions": pa.array([[squeezed_rising(p) for p in positions]], pa.list_(pa.binary())),
                     **{name: pa.array([x], pa.list_(kind)) for name, x, kind in
                        zip(("code", "zeros", "ones", "below"), nodes, (pa.int64(), *[pa.float64()] * 3))}})


MERGED = f"bucket int, part int, keys binary, counts binary, chunks array<int>, positions array<binary>, {NODES}"


def of_part(rows: pa.Table) -> pa.Table:
    """The two-byte nodes of a part in one row, and what contexts of one byte need to know of them."""
    second = Second(*([v.values.to_numpy() for v in rows.column(c)] for c in ("code", "zeros", "ones", "below")))
    byte_node = (second.code >> 8 & 255) << 8 | second.code & 255
    code, to = np.unique(byte_node, return_inverse=True)
    first = [np.bincount(to, v, len(code)) for v in (second.zeros, second.ones, second.log_w)]
    kinds = (pa.int64(), *[pa.float64()] * 3)
    return pa.table({"part": pa.array([rows.column("part")[0].as_py()], pa.int32())} | {
        name: pa.array([x], pa.list_(kind)) for name, x, kind in zip(("code", "zeros", "ones", "below"), (second.code, second.zeros, second.ones, second.below), kinds)
    } | {name: pa.array([x], pa.list_(kind)) for name, x, kind in zip(("code1", "zeros1", "ones1", "below1"), (code, *first), kinds)})


OF_PART = f"part int, {NODES}, code1 array<long>, zeros1 array<double>, ones1 array<double>, below1 array<double>"


SCORES = ("doc_id long, n_tokens long, n_known long, base_score double, score double, bits_per_byte double")


def score_texts(documents: DataFrame, learn: Column, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Per document row: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10), bits_per_byte.

    ``learn`` marks the rows the model learns from. ``base_score`` is the add-one word model's log10 probability.
    """
    spark = documents.sparkSession
    chars = documents.agg(F.sum(F.length("text"))).first()[0] or 0
    n_chunks = max(1, math.ceil(chars / chunk_chars))
    n_buckets = SALTS * max(1, math.ceil(n_chunks / 8))
    docs = chunked(documents, learn, n_chunks)
    found = staged(docs.groupBy("chunk").applyInArrow(lambda chunk: contents(chunk, n_buckets), FOUND), "chunk-contents")
    vocabulary = staged(found.where("word").groupBy("bucket").applyInArrow(
        merged_words, "bucket int, chunks array<int>, values array<binary>, total double, known long"), "words")
    n_train, v = vocabulary.agg(F.sum("total"), F.sum("known")).first()
    n_train, v = n_train or 0.0, v or 0
    buckets = staged(found.where("not word").groupBy("bucket").applyInArrow(merged, MERGED), "buckets")
    drop_staged(found)
    parts = staged(buckets.select("part", "code", "zeros", "ones", "below").groupBy("part").applyInArrow(of_part, OF_PART), "two-byte-nodes")
    rows = parts.select(F.explode(F.arrays_zip("code1", "zeros1", "ones1", "below1")).alias("x")).groupBy(
        F.shiftright("x.code1", 8).cast("int").alias("byte"), F.col("x.code1").bitwiseAND(F.lit(255)).cast("int").alias("node")).agg(
        F.sum("x.zeros1").alias("zeros"), F.sum("x.ones1").alias("ones"), F.sum("x.below1").alias("below"))
    top = spark.sparkContext.broadcast(Top(rows.collect()))  # at most 256 x 255 rows

    def log_probabilities(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                bucket, keys, counts, chunks, positions, *nodes = (c[i] for c in batch.columns)
                second = Second(*([x.values.to_numpy()] for x in nodes))
                x = Levels(unsqueezed_rising(keys.as_py()), unsqueezed(counts.as_py(), np.float64), 3, ordered=True)
                total = 0.0
                for bit in range(8):
                    x.bit(bit)
                    total = total + np.log10(top.value.finish(x, second))
                total = total.astype(np.float32)
                values = [squeezed(total[unsqueezed_rising(p.as_py()).astype(np.int64)]) for p in positions]
                yield pa.RecordBatch.from_arrays([pa.array(chunks.as_py(), pa.int32()), pa.array([bucket.as_py()] * len(values), pa.int32()),
                                                  pa.array([False] * len(values)), pa.array(values, pa.binary())], names=["chunk", "bucket", "word", "values"])

    of_bucket = parts.select(F.col("part").alias("_part"), *[F.col(c).alias(f"_{c}") for c in ("code", "zeros", "ones", "below")])
    model = buckets.drop("code", "zeros", "ones", "below").join(of_bucket, F.col("part") == F.col("_part")).select(
        "bucket", "keys", "counts", "chunks", "positions", "_code", "_zeros", "_ones", "_below")
    of_words = vocabulary.select("bucket", F.explode(F.arrays_zip("chunks", "values")).alias("x")).select(
        F.col("x.chunks").alias("chunk"), "bucket", F.lit(True).alias("word"), F.col("x.values").alias("values"))
    given = of_words.unionAll(model.mapInArrow(log_probabilities, "chunk int, bucket int, word boolean, values binary"))
    whole = math.log10(n_train + v + 1)

    def scored(chunk: pa.Table, given: pa.Table) -> pa.Table:
        docs = chunk_rows(chunk)
        texts, rows = [coded(t.as_py()) for t in docs.column("text")], docs.num_rows
        def values(word: bool, kind) -> np.ndarray:
            own = given.filter(pc.equal(given.column("word"), word)).sort_by("bucket").column("values")
            return np.concatenate([unsqueezed(x.as_py(), kind) for x in own])

        text, codes, _, _ = tokens(texts, n_buckets)
        c = values(True, np.int64)[codes]
        n, known, base = (np.bincount(text, x, rows) for x in (None, c > 0, np.log10(c + 1)))
        del text, codes, c
        runs = list(sorted_runs(texts))
        keys, at = ranked(np.concatenate([r[0] for r in runs]))
        at = np.split(at, np.cumsum([len(r[0]) for r in runs])[:-1])
        log_of = np.empty(len(keys), np.float32)  # values come in the order that ``contents`` dealt the keys in
        log_of[np.argsort(buckets_of(keys, n_buckets), kind="stable")] = values(False, np.float32)
        score, n_bytes = np.zeros(rows), np.fromiter(map(len, texts), float, rows)
        for (_, often, text), own in zip(runs, at):
            score += np.bincount(text, np.repeat(log_of[own], often), rows)
        return pa.table({"doc_id": docs.column("doc_id"), "n_tokens": pa.array(n.astype(np.int64)),
                         "n_known": pa.array(known.astype(np.int64)),
                         "base_score": pa.array(base - n * whole), "score": pa.array(score),
                         "bits_per_byte": pa.array(-score * LOG10 / math.log(2) / n_bytes)})

    both = docs.groupBy("chunk").cogroup(given.groupBy("chunk"))
    return both.applyInArrow(scored, SCORES).withColumn("train_tokens", F.lit(int(n_train)).cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    kept = held_out(F.col("doc_id"), 7, 2)
    scores = score_texts(table(spark, sf_dir, "documents"), ~kept)
    return scores.select("doc_id", kept.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
