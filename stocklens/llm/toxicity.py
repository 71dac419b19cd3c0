"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Inputs: a text's words (letters and digits, lower case). A word enters as its own hashed embedding beside the
mean of its hashed character n-grams, so unseen forms of a stem are understood. Two gated recurrent
layers read each window of ``WINDOW`` words, one per direction; attention pools their states; a linear
unit gives the window's logit. Windows overlap by half and cover the whole text, so a passage of up to ``WINDOW - STRIDE + 1``
words lies whole in one of them wherever it stands; a text's logit is its highest.

Training: labels are per text, so training alternates between picking each text's highest window under the
model and descending on the picked windows (Adam, gradients by hand). The sample is bounded: the
``SAMPLE`` labelled texts of class 0 and class 1 with the smallest hashed ids among those of at most
``SAMPLE_CHARS`` characters (both bounds are parameters; texts of any length are scored whole). The sample is chosen by ids and
lengths alone; its texts are then picked from one scan by a broadcast of at most ``sum(SAMPLE)`` ids, and its words
are numbered a few texts at a time, so no task or shuffle holds texts and the driver holds the sample only. Embeddings start from each feature's log odds in the sample, and a last logistic fit on
text logits sets the scale of scores. The model has a fixed size and is broadcast.

Scoring streams texts in runs of about two megabytes, and their rows are given out run by run: inputs are projected once per distinct word of a run.

Nulls and ties: texts without words (null, empty) have one empty window and get a score too. Labels with a
null id or label are left out; without both classes every score is 0. Of rows with an equal id the smallest text is learned from. A very long text
is scored in one run of its own, whose memory grows with its words. Extra columns pass through ``without_toxic`` unread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import alnum_words, held_out, mix64, pieces, table, utf8

WINDOW, STRIDE = 32, 16
WORD_BUCKETS, GRAM_BUCKETS, GRAMS = 1 << 18, 1 << 18, (3, 5)
DIM, HIDDEN, SEED = 6, 4, 7
SAMPLE, SAMPLE_CHARS = (4500, 1500), 20_000
RUN_BYTES, THRESHOLD, WORDS_AT_ONCE = 2_000_000, 0.5, 32_768


def word_features(names: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, n-gram buckets of all words in a row, first n-gram of each word)."""
    marked = b"".join(b"<" + w + b">" for w in names)
    raw = np.frombuffer(marked, np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, names), np.int64, len(names)) + 2
    start = np.cumsum(size) - size
    inside = np.arange(len(raw)) - np.repeat(start, size)
    spread = mix64(raw + (inside.astype(np.uint64) << np.uint64(8)))
    own = mix64(np.add.reduceat(spread, start)) % np.uint64(WORD_BUCKETS)
    count = [np.maximum(size - n + 1, 0) for n in GRAMS]
    first = np.concatenate([[0], np.cumsum(sum(count))])
    out, done = np.empty(first[-1], np.int64), np.zeros(len(names), np.int64)
    for n, c in zip(GRAMS, count):
        at = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)  # place within the word
        place = np.repeat(start, c) + at
        key = np.full(len(at), n, np.uint64)
        for j in range(n):
            key = key << np.uint64(8) | raw[place + j]
        out[np.repeat(first[:-1] + done, c) + at] = mix64(key) % np.uint64(GRAM_BUCKETS)
        done += c
    return own.astype(np.int64), out, first


def means(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of each word's rows; every word has an n-gram, its two end marks included."""
    if len(first) == 1:
        return np.zeros((0, rows.shape[1]), np.float32)
    return np.add.reduceat(rows, first[:-1], axis=0) / np.diff(first)[:, None].astype(np.float32)


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text of each window, its first word's place in the text); at least one per text, all words covered."""
    n = 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE))
    text = np.repeat(np.arange(len(counts)), n)
    return text, (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRIDE


class Run:
    """Some texts as word numbers, with the features of their distinct words and their windows."""

    def __init__(self, texts: list[bytes | None]):
        known: dict[bytes, int] = {}
        parts, self.counts = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):  # a text's words live until they are numbered
            ws = alnum_words(text)
            self.counts[i] = len(ws)
            parts.append(np.fromiter((known.setdefault(w, len(known)) for w in ws), np.int32, len(ws)))
        codes = self.flat = np.concatenate(parts)
        names = list(known)
        own, grams, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for i in range(0, len(names), WORDS_AT_ONCE):
            o, g, f = word_features(names[i:i + WORDS_AT_ONCE])
            own.append(o)
            grams.append(g.astype(np.int32))
            sizes.append(np.diff(f))
        self.own, self.grams, self.first = np.concatenate(own), np.concatenate(grams), np.concatenate(sizes).cumsum()
        self.text, start = windows(self.counts)
        begin = (np.cumsum(self.counts) - self.counts).astype(np.int32)  # a run has fewer than 2 ** 31 words
        place = start.astype(np.int32)[:, None] + np.arange(WINDOW, dtype=np.int32)
        self.mask = place < self.counts[self.text].astype(np.int32)[:, None]
        padded = np.append(codes, np.int32(len(names)))  # the last number is no word
        place += begin[self.text][:, None]
        place[~self.mask] = len(padded) - 1
        self.words = padded[place]


def sigmoid(x: np.ndarray) -> np.ndarray:
    y = np.tanh(x * np.float32(0.5))
    y += np.float32(1)
    y *= np.float32(0.5)
    return y


class Network:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        def normal(*shape, scale=0.1):
            return (rng.standard_normal(shape) * scale).astype(np.float32)
        h, d = HIDDEN, 2 * DIM
        self.p = {"word": normal(WORD_BUCKETS, DIM, scale=0.02), "gram": normal(GRAM_BUCKETS, DIM, scale=0.02),
                  "att": normal(2 * h, h, scale=0.4), "attv": normal(h, scale=0.4), "out": normal(2 * h, scale=0.4), "bias": np.zeros(1, np.float32)}
        for s in "fb":
            self.p |= {f"w{s}": normal(d, 3 * h, scale=0.4), f"u{s}": normal(h, 3 * h, scale=0.3), f"c{s}": np.zeros(3 * h, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, run: Run) -> np.ndarray:
        """Vector of each distinct word, and zeros for no word."""
        x = np.zeros((len(run.own) + 1, 2 * DIM), np.float32)
        for i in range(0, len(run.own), WORDS_AT_ONCE):
            first = run.first[i:i + WORDS_AT_ONCE + 1]
            rows = slice(i, i + len(first) - 1)
            x[rows, :DIM] = self.p["word"][run.own[rows]]
            x[rows, DIM:] = means(self.p["gram"][run.grams[first[0]:first[-1]]], first - first[0])
        return x

    def forward(self, x: np.ndarray, words: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows of word numbers; with ``keep`` also what the gradient needs."""
        p, h = self.p, HIDDEN
        n, steps = words.shape
        states, trace = np.empty((steps, n, 2 * h), np.float32), {}
        for s, order, cols in (("f", range(steps), slice(0, h)), ("b", range(steps - 1, -1, -1), slice(h, 2 * h))):
            # One table and one matrix per gate, so that each step works on whole contiguous arrays.
            uz, ur, uc = (np.ascontiguousarray(v) for v in np.split(p[f"u{s}"], 3, axis=1))
            xz, xr, xc = (np.ascontiguousarray(v) for v in np.split(x @ p[f"w{s}"] + p[f"c{s}"], 3, axis=1))
            now, kept, whole = np.zeros((n, h), np.float32), [], mask.all()
            for t in order:
                own = words[:, t]
                z, r, uh = sigmoid(xz[own] + now @ uz), sigmoid(xr[own] + now @ ur), now @ uc
                c = np.tanh(xc[own] + r * uh)
                m = mask[:, t, None]
                new = now + z * (c - now)
                if not whole:
                    new = np.where(m, new, now)
                if keep:
                    kept.append((t, now, z, r, c, uh, m))
                now = new
                states[t, :, cols] = now
            trace[s] = kept
        u = np.tanh(states @ p["att"])
        e = np.where(mask.T, u @ p["attv"], np.float32(-1e9))
        w = np.exp(e - e.max(axis=0)) * mask.T
        w /= np.maximum(w.sum(axis=0), np.float32(1e-9))
        pooled = np.einsum("tn,tni->ni", w, states)
        logit = pooled @ p["out"] + p["bias"][0]
        return (logit, (states, u, w, pooled, trace)) if keep else logit

    def gradient(self, x: np.ndarray, words: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """(gradient of the mean logistic loss by parameter, and by input vector)."""
        p, h = self.p, HIDDEN
        logit, (states, u, w, pooled, trace) = self.forward(x, words, mask, keep=True)
        d = ((sigmoid(logit) - y) / len(y)).astype(np.float32)
        g = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
        dpool = d[:, None] * p["out"]
        dstates = w[:, :, None] * dpool
        de = (states * dpool).sum(axis=2)
        de = w * (de - (w * de).sum(axis=0))
        g["attv"] = (u * de[:, :, None]).sum(axis=(0, 1))
        du = de[:, :, None] * p["attv"] * (1 - u * u)
        g["att"] = np.einsum("tni,tnj->ij", states, du)
        dstates += du @ p["att"].T
        dx = np.zeros_like(x)
        for s, cols in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            gu, gw, gc = np.zeros_like(p[f"u{s}"]), np.zeros_like(p[f"w{s}"]), np.zeros(3 * h, np.float32)
            carry = np.zeros((len(y), h), np.float32)
            for t, before, z, r, c, bc, m in reversed(trace[s]):
                total = carry + dstates[t, :, cols]
                live = np.where(m, total, 0)
                dz, dc = live * (c - before) * z * (1 - z), live * z * (1 - c * c)
                dr = dc * bc * r * (1 - r)
                da = np.concatenate([dz, dr, dc], axis=1)
                db = np.concatenate([dz, dr, dc * r], axis=1)
                gu += before.T @ db
                gc += da.sum(axis=0)
                carry = np.where(m, live * (1 - z), total) + db @ p[f"u{s}"].T
                own = words[:, t]
                gw += x[own].T @ da
                np.add.at(dx, own, da @ p[f"w{s}"].T)
            g |= {f"u{s}": gu, f"w{s}": gw, f"c{s}": gc}
        return g, dx

    def start_from_odds(self, run: Run, y: np.ndarray) -> None:
        """Set the first embedding column to each feature's log odds of standing in a positive text."""
        last = np.cumsum(run.counts)
        hits = {"word": np.zeros((2, WORD_BUCKETS)), "gram": np.zeros((2, GRAM_BUCKETS))}
        for i in range(0, len(y), 200):  # a few texts at a time, since their n-grams are many
            owner = np.repeat(np.arange(i, min(i + 200, len(y))), run.counts[i:i + 200])
            pairs = np.unique(owner * (len(run.own) + 1) + run.flat[last[i] - run.counts[i]:last[min(i + 200, len(y)) - 1]])
            owner, words = pairs // (len(run.own) + 1), pairs % (len(run.own) + 1)
            sizes = np.diff(run.first)[words]
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(run.first[words], sizes)
            for name, of, bucket in (("word", owner, run.own[words]), ("gram", np.repeat(owner, sizes), run.grams[at])):
                size = hits[name].shape[1]
                both = np.unique(of * size + bucket)
                for c in (0, 1):
                    hits[name][c] += np.bincount(both[y[both // size] == c] % size, minlength=size)
        n = [(y == c).sum() + 1 for c in (0, 1)]
        for name, scale, most in (("word", 4, 2), ("gram", 2, 3)):
            low, high = hits[name]
            odds = (np.log((high + 0.5) / n[1]) - np.log((low + 0.5) / n[0])) * (low + high >= 5)
            self.p[name][:, 0] = np.clip(odds / scale, -1, most)
        start = np.zeros(2 * DIM, np.float32)
        start[0], start[DIM] = 1, 1
        self.guide = start

    def text_logits(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        """(highest window logit of each text, logits of all windows)."""
        x, out = self.inputs(run), np.empty(len(run.text), np.float32)
        full = run.mask.all(axis=1)
        for rows in (np.where(full)[0], np.where(~full)[0]):  # whole windows need no mask
            for i in range(0, len(rows), 4096):
                at = rows[i:i + 4096]
                out[at] = self.forward(x, run.words[at], run.mask[at])
        first = np.searchsorted(run.text, np.arange(len(run.counts)))
        return np.maximum.reduceat(out, first), out

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        top, _ = self.text_logits(Run(texts))
        return 1 / (1 + np.exp(-np.clip(self.scale * top.astype(float) + self.shift, -60, 60)))


def train(texts: list[bytes | None], y: np.ndarray, rounds: int = 4, epochs: int = 2, rate: float = 0.02, seed: int = SEED) -> Network | None:
    """Network trained on labelled texts; None without both classes."""
    if len(set(y.tolist())) < 2:
        return None
    net, run, rng = Network(seed), Run(texts), np.random.default_rng(seed)
    net.start_from_odds(run, y)
    guide = (net.inputs(run) @ net.guide)[run.words]
    level = np.where(run.mask, guide, -9).max(axis=1)
    first = np.searchsorted(run.text, np.arange(len(run.counts)))
    state: dict[str, list[np.ndarray]] = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    step = 0
    for turn in range(rounds):
        if turn:
            _, level = net.text_logits(run)
        best = np.lexsort((level, run.text))[np.append(first[1:], len(run.text)) - 1]  # the highest window of each text
        negative = np.where(y[run.text] == 0)[0]
        picked = np.concatenate([best, rng.choice(negative, min(len(negative), len(best)), replace=False)])
        target = y[run.text[picked]].astype(np.float32)
        for _ in range(max(epochs, 12_000 // len(picked))):  # a small sample needs as many steps
            order = rng.permutation(len(picked))
            for i in range(0, len(order), 256):
                step += 1
                rows = picked[order[i:i + 256]]
                used, local = np.unique(run.words[rows], return_inverse=True)
                x = _inputs(net, run, used)
                g, dx = net.gradient(x, local.reshape(len(rows), -1), run.mask[rows], target[order[i:i + 256]])
                _embed(net, run, used, dx, state, rate, step)
                for k, v in g.items():
                    m, s = state[k]
                    m += 0.1 * (v - m)
                    s += 0.001 * (v * v - s)
                    net.p[k] -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    top, _ = net.text_logits(run)
    a, b = 1.0, 0.0
    for _ in range(200):  # logistic fit of the text logits, a little damped
        q = 1 / (1 + np.exp(-np.clip(a * top + b, -30, 30))) - y
        a, b = a - 0.05 * ((q * top).mean() + 0.01 * (a - 1)), b - 0.5 * q.mean()
    net.scale, net.shift = float(max(a, 0.05)), float(b)
    return net


def _spans(run: Run, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(real words of ``used``, places of their n-grams, first place of each)."""
    real = used[used < len(run.own)]
    size = run.first[real + 1] - run.first[real]
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(run.first[real], size)
    return real, at, np.concatenate([[0], np.cumsum(size)])


def _inputs(net: Network, run: Run, used: np.ndarray) -> np.ndarray:
    real, at, first = _spans(run, used)
    x = np.concatenate([net.p["word"][run.own[real]], means(net.p["gram"][run.grams[at]], first)], axis=1)
    return np.concatenate([x, np.zeros((len(used) - len(real), x.shape[1]), np.float32)])


def _embed(net: Network, run: Run, used: np.ndarray, dx: np.ndarray, state, rate: float, step: int) -> None:
    """Adagrad step on the embeddings of the words in use."""
    real, at, first = _spans(run, used)
    dx = dx[:len(real)]
    size = np.maximum(np.diff(first), 1)
    for name, bucket, grad in (("word", run.own[real], dx[:, :DIM]), ("gram", run.grams[at], np.repeat(dx[:, DIM:] / size[:, None], np.diff(first), axis=0))):
        rows, where = np.unique(bucket, return_inverse=True)
        total = np.stack([np.bincount(where, grad[:, j], minlength=len(rows)) for j in range(DIM)], axis=1).astype(np.float32)
        past = state[name][1]
        past[rows] += total * total
        net.p[name][rows] -= rate * total / (np.sqrt(past[rows]) + 1e-6)


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", sample: tuple[int, int] = SAMPLE,
        sample_chars: int = SAMPLE_CHARS) -> Network | None:
    """Train on a bounded sample of labelled documents, ``sample`` by class."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("y"))
    fits = documents.where(F.coalesce(F.length("text"), F.lit(0)) <= sample_chars)
    docs = fits.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"))
    labelled = docs.select("doc_id").join(known, F.col("doc_id") == F.col("_id")).select("doc_id", "y").distinct()
    order = [F.xxhash64(F.lit(SEED), "doc_id"), "doc_id"]
    ids = [r for c in (0, 1) for r in labelled.where(F.col("y") == c).orderBy(*order).limit(sample[c]).collect()]
    if not ids:
        return None
    chosen = documents.sparkSession.createDataFrame(ids, "_id long, y int")
    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    got = rows.toArrow().sort_by([("doc_id", "ascending"), ("y", "ascending")])
    texts, y = got.column("text").to_pylist(), got.column("y").to_numpy().astype(np.int64)
    del got
    return train(texts, y)


def score(documents: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of each row's whole text."""
    sent = documents.sparkSession.sparkContext.broadcast(net)

    def rows(batches):
        model = sent.value
        for batch in batches:
            for ids, texts in pieces(batch, RUN_BYTES):
                p = model(texts) if model else np.zeros(len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(p, pa.float64()),
                                                  pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return documents.select(F.col("doc_id").cast("long"), utf8(F.col("text"))).mapInArrow(
        rows, "doc_id long, score double, predicted int")


def without_toxic(documents: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, whole, whose text scores below the threshold."""
    sent, text = documents.sparkSession.sparkContext.broadcast(net), documents.columns.index("text")

    def rows(batches):
        model = sent.value
        for batch in batches:
            if model is None:
                yield batch
                continue
            plain = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows)), batch.column(text).cast(pa.binary())], names=["row", "text"])
            for ids, texts in pieces(plain, RUN_BYTES):
                yield batch.slice(ids[0], len(ids)).filter(pa.array(model(texts) < threshold))

    return documents.mapInArrow(rows, documents.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fit(docs.where(~held_out(F.col("doc_id"), 5, 0)), table(spark, sf_dir, "labels"))
    return score(docs, net).select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")
