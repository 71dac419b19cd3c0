"""Benchmark decontamination by a prefix-filtered join of word windows.

An item's windows are its runs of ``window`` words (the whole item if it has fewer, but not none).
A document contains a window exactly, so of a window's shingles (pairs of neighbouring words) all
must occur in the documents and the necessary prefix is its one rarest shingle. Shingles are ordered by
how many documents hold them, counted over all documents; a window with a shingle that none holds
is out. Document positions are joined with windows on the prefix shingle and its place in the window: a pair names a
window and its start, must fit the words around (positional and length bounds), and is then compared word by word.

Neither side passes the driver. Documents are read twice, once to count and once to join; each time a
filter of at most ``FILTER_BITS`` bits over the wanted shingles (8 MB at most, two bits a shingle) is broadcast and lets go of
the other positions before any shuffle. The more documents there are, the more windows have all their shingles in some of them,
so the second time another filter of that size, over hashes of whole windows and their prefix's place, is asked for every
window that a position may be the prefix of. Candidates are thus the windows that occur and those that either filter
lets through by chance; the latter meet nothing in the join, so a benchmark too large for the filters costs time,
not results. A candidate carries its window's words. The windows are a
written table, so Spark broadcasts it only if its files are below ``spark.sql.autoBroadcastJoinThreshold``; beyond that
a shingle or passage that a third of all documents hold is split by adaptive execution, since the
other side has few rows of it.

Shingles are compared by 64-bit hashes first and by their words in the end, so a clash costs a comparison only.
Windows are told apart by md5, document rows by id and a 64-bit hash of the text.

Nulls: a null or empty text has no words and no hits; an item without words has no windows; items
with a null id are left out. Repeated items count once by id. Repeated document rows give a row
each; without items no row is hit. Other columns are kept by ``without_contaminated`` and never read.
A very long text is read whole, by one task, its candidates in rows of ``CANDIDATES`` each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.common import ALNUM_WORD, UPPER, LOWER, alnum_words, mix64, staged, table, utf8

WINDOW = 13
FILTER_BITS, CANDIDATES, WINDOW_ROWS = 1 << 26, 1000, 5000


SPREAD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingle_keys(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of each pair of neighbouring words, and of each word alone (a one-word window's shingle), by the words' hashes."""
    return mix64(h[:-1] * SPREAD + h[1:]).view(np.int64), mix64(h ^ np.uint64(0x5851F42D4C957F2D)).view(np.int64)


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the n words from each word on."""
    m = max(0, len(h) - n + 1)
    out = h[:m].copy()
    for i in range(1, n):
        out *= SPREAD
        out += h[i:i + m]
    return out


def placed(window: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit keys of windows, by their hashes, and a place in each."""
    return mix64(window + at.astype(np.uint64)).view(np.int64)


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """One row per item and window: item_id, win (its words, blank between), n, shingles, places (keys of the window and each shingle's place), win_key."""
    def rows(batches):
        def batch():
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(wins, pa.string()), pa.array(sizes, pa.int32()),
                                               pa.array(keys, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int64()))],
                                              names=["item_id", "win", "n", "shingles", "places"])

        ids, wins, sizes, keys, places = [], [], [], [], []
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = alnum_words(text.as_py())
                n = min(window, len(words))
                h = word_hashes(words)
                pairs, singles = shingle_keys(h)
                hashes, at = window_hashes(h, n), np.arange(max(1, n - 1))
                for i in range(len(words) - n + 1 if words else 0):
                    ids.append(item), sizes.append(n), wins.append(b" ".join(words[i:i + n]).decode())
                    keys.append(pairs[i:i + n - 1] if n > 1 else singles)
                    places.append(placed(hashes[i], at))
                    if len(ids) >= WINDOW_ROWS:
                        yield batch()
                        ids, wins, sizes, keys, places = [], [], [], [], []
        yield batch()

    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), utf8(F.col("text")))
    found = items.mapInArrow(rows, "item_id long, win string, n int, shingles array<long>, places array<long>")
    return staged(found.withColumn("win_key", F.unhex(F.md5("win"))).dropDuplicates(["item_id", "win_key"]), "item-windows")


class Sieve:
    """A filter over 64-bit keys: two bits each of a bitmap, whose size follows their number up to a bound."""

    def __init__(self, keys: DataFrame, most: int):
        """``keys`` has one column, ``key``."""
        n = keys.agg(F.approx_count_distinct("key")).first()[0]
        size = 64
        while size < min(16 * n, most):
            size *= 2
        self.mask = size - 1
        bits = keys.select(F.explode(F.array("key", F.shiftrightunsigned("key", 32))).alias("b")).select(
            F.col("b").bitwiseAND(F.lit(self.mask).cast("long")).alias("b"))
        words = bits.groupBy(F.shiftright("b", 6).alias("at")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b").bitwiseAND(F.lit(63).cast("long")).cast("int"))).alias("bits")).toArrow()
        self.bits = np.zeros(size // 64, np.int64)
        self.bits[words.column("at").to_numpy()] = words.column("bits").to_numpy()

    def passed(self, key: np.ndarray) -> np.ndarray:
        """Positions of the keys that may be wanted."""
        def hit(k: np.ndarray) -> np.ndarray:
            k = k & self.mask
            return (self.bits[k >> 6] >> (k & 63)) & 1
        at = np.flatnonzero(hit(key))
        return at[hit((key[at].view(np.uint64) >> np.uint64(32)).view(np.int64)) > 0]


def document_counts(docs: DataFrame, sieve: Sieve, singles: bool) -> DataFrame:
    """(shingle, often): how many documents hold each shingle that the filter lets through."""
    sent = docs.sparkSession.sparkContext.broadcast(sieve)

    def rows(batches):
        for b in batches:
            met = []
            for text in b.column(0):
                for keys in shingle_keys(word_hashes(alnum_words(text.as_py())))[:2 if singles else 1]:
                    met.append(np.unique(keys[sent.value.passed(keys)]))
            key, n = np.unique(np.concatenate(met) if met else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], names=["shingle", "n"])

    return docs.select("text").mapInArrow(rows, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("often"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Per window whose shingles all occur: win_key, shingle (its rarest) and where in the window it stands."""
    each = windows.select("win_key", F.size("shingles").alias("_size"), F.posexplode("shingles").alias("at", "shingle"))
    held = each.join(counts.withColumnRenamed("shingle", "_shingle"), F.col("shingle") == F.col("_shingle"))
    return held.groupBy("win_key").agg(F.min(F.struct("often", "shingle", "at")).alias("_p"), F.count(F.lit(1)).alias("_met"), F.first("_size").alias("_size")
                                       ).where("_met = _size").select("win_key", "_p.shingle", "_p.at")


def occurring(words: list[bytes], prefix: Sieve, whole: Sieve, sizes: list[int]) -> list[tuple[int, int, int, int]]:
    """(shingle, its place in the window, the window's start, its words) of the windows of ``sizes`` words that both filters let through."""
    h = word_hashes(words)
    pairs, singles = shingle_keys(h)
    met = {False: prefix.passed(pairs), True: prefix.passed(singles) if 1 in sizes else ()}
    found = []
    for n in sizes:
        keys, at = (singles, met[True]) if n == 1 else (pairs, met[False])
        if len(h) < n or not len(at):
            continue
        start = at[:, None] - np.arange(max(1, n - 1))
        row, place = np.nonzero((start >= 0) & (start <= len(h) - n))
        start = start[row, place]
        kept = whole.passed(placed(window_hashes(h, n)[start], place))
        found += zip(keys[at[row[kept]]].tolist(), place[kept].tolist(), start[kept].tolist(), [n] * len(kept))
    return found


def candidates(docs: DataFrame, prefix: Sieve, whole: Sieve, sizes: list[int]) -> DataFrame:
    """Document rows with n_words, and in rows of a limited size (n_words null from the second on) the windows that both filters let through."""
    sent = docs.sparkSession.sparkContext.broadcast((prefix, whole))
    one = pa.struct([("shingle", pa.int64()), ("place", pa.int32()), ("start", pa.int64()), ("words", pa.string())])

    names = ["doc_id", "text_hash", "n_words", "found"]

    def rows(batches):
        for b in batches:
            kinds = [b.schema.field(0).type, pa.int64(), pa.int64(), pa.list_(one)]
            out, held = ([], [], [], []), 0
            for doc_id, text, text_hash in zip(*[b.column(c) for c in range(3)]):
                words = alnum_words(text.as_py())
                found = occurring(words, *sent.value, sizes)
                for first in range(0, max(1, len(found)), CANDIDATES):
                    here = [{"shingle": k, "place": p, "start": i, "words": b" ".join(words[i:i + n]).decode()}
                            for k, p, i, n in found[first:first + CANDIDATES]]
                    for column, value in zip(out, (doc_id.as_py(), text_hash.as_py(), None if first else len(words), here)):
                        column.append(value)
                    held += len(here)
                    if held >= CANDIDATES:
                        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)
                        out, held = ([], [], [], []), 0
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)

    return staged(docs.mapInArrow(rows, f"doc_id {dict(docs.dtypes)['doc_id']}, text_hash long, n_words long, "
                                        "found array<struct<shingle:long,place:int,start:long,words:string>>"), "candidates")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Per document row: doc_id, n_words, spans (word positions hit: start, end), item_ids, text_hash."""
    docs = documents.select("doc_id", utf8(F.col("text")).alias("text"), F.xxhash64("text").alias("text_hash"))
    owned = item_windows(benchmark, window)
    windows = owned.dropDuplicates(["win_key"]).select("win_key", "win", "n", "shingles", "places")
    sizes = sorted(r["n"] for r in owned.select("n").distinct().collect())  # at most ``window`` of them
    wanted = owned.select(F.explode("shingles").alias("key"))
    first = staged(prefixes(windows, document_counts(docs, Sieve(wanted, filter_bits), 1 in sizes)).join(
        windows.select(F.col("win_key").alias("_key"), "win", "n", "places"), F.col("win_key") == F.col("_key")).select(
        "win_key", "shingle", "at", "win", "n", F.get("places", "at").alias("key")), "prefixes")
    held = candidates(docs, Sieve(first.select(F.col("shingle").alias("key")), filter_bits), Sieve(first.select("key"), filter_bits), sizes)
    met = held.select("doc_id", "text_hash", F.explode("found").alias("_f")).select(
        "doc_id", "text_hash", "_f.*").withColumnRenamed("shingle", "_shingle")
    pairs = met.join(first, (F.col("_shingle") == F.col("shingle")) & (F.col("place") == F.col("at")))
    hits = staged(pairs.where(F.col("words") == F.col("win")).select(
        "doc_id", "text_hash", "start", (F.col("start") + F.col("n")).alias("end"), "win_key").distinct(), "hits")
    row = ["doc_id", "text_hash"]
    # Windows that meet or overlap are one span: a span starts where no earlier window reaches.
    along = Window.partitionBy(*row).orderBy("start", "end")
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    spans = (hits.select(*row, "start", "end").distinct().withColumn("_new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("long"))
             .withColumn("_span", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy(*row, "_span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
             .groupBy(*row).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")))
    items = (hits.select(*row, "win_key").distinct().join(owned.select(F.col("win_key").alias("_key"), "item_id"), F.col("win_key") == F.col("_key"))
             .groupBy(*row).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")))
    out = held.where("n_words is not null").select("doc_id", "n_words", "text_hash")
    for part, name in ((spans, "spans"), (items, "item_ids")):
        part = part.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), name)
        out = out.join(part, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left").drop("_doc", "_hash")
    return out.select("doc_id", "n_words", F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
                      F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), "text_hash")


def verdicts(found: DataFrame, *more: str) -> DataFrame:
    """Contamination rule: at least one word in twenty lies in a window of some item."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    names = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
                        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), *more)


def without_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``documents`` that the contamination rule leaves."""
    found = contamination(documents, benchmark, **options)
    bad = verdicts(found, "text_hash").where("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(documents["text"]) == bad["_hash"]), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return verdicts(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


SQL = f"""
WITH d AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (
        SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{ALNUM_WORD}') AS w FROM documents)),
b AS (SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{ALNUM_WORD}') AS w
      FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - {WINDOW - 1}))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dl AS (SELECT doc_id, list(word ORDER BY pos) AS w, count(*) AS n_words FROM d GROUP BY doc_id),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dl, sizes)),
m AS (SELECT DISTINCT doc_id, item_id, i, n FROM dw JOIN bw USING (win, n)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
        SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(n_words, 0) AS contaminated
FROM documents LEFT JOIN dl USING (doc_id) LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
