"""Near duplicates by b-bit MinHash: packed signatures, band candidates, corrected estimates, exact links.

1. One pass over the texts gives each document's shingle set as 64-bit hashes, its ``K`` minima, a
   128-bit key of the whole set, the low ``b`` bits of the minima packed into longs, and a key per band.
2. Documents with equal sets become one class, represented by the smallest id, so a text with a third
   of all rows is one row from here on.
3. Classes that share a band key are candidates. There are as many bands of 5 rows as a pair at the threshold
   needs to be missed once in a million at most (``bands_for``: 24 at 0.85, 36 at 0.8). Rather than all pairs of a bucket, each member meets a few hubs of the
   bucket, chosen by aggregates that are combined map-side. A candidate's similarity is estimated by bit
   counts, corrected for chance agreement of b bits, and let through if it may reach the threshold
   (``lowest_estimate``, of the same loss; what it drops is met again in step 4).
4. Those pairs are confirmed on the full sets. Then only buckets that still hold several components matter:
   they are compared across components by an exact prefix filter over
   their sets and confirmed without an estimate. Pairs inside a component can't change it, so what is lost
   is pairs without a common band.
5. Components come from star contraction on the confirmed links (``common.components``).

Nulls and ties: null, empty and blank texts have an empty set and are linked with nothing. Rows with
equal ids are one document as far as components go. A row with a null id is its own, kept, with a null component.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import components, mix64, numbered, pieces, staged, table, utf8, words

ROWS, BITS, SEED = 5, 2, 20240607
PER_LONG = 30
#: Most that bands, and the estimate of hub pairs, may each miss of the pairs at the threshold.
LOSS = 1e-6
HUBS = 2


def bands_for(threshold_percent: int) -> int:
    """Bands that a pair at the threshold shares none of with probability LOSS at most; their minima fill longs."""
    same = (threshold_percent / 100) ** ROWS
    step = PER_LONG // math.gcd(PER_LONG, ROWS)
    need = math.log(LOSS) / math.log1p(-same) if same < 1 else 1
    return step * math.ceil(need / step)


def lowest_estimate(threshold_percent: int, k: int) -> float:
    """Estimate that a pair at the threshold falls below with probability LOSS at most (exact binomial tail)."""
    chance = 2.0 ** -BITS
    p = threshold_percent / 100 * (1 - chance) + chance
    agree, below = 0, (1 - p) ** k
    while below <= LOSS and agree < k:
        agree += 1
        below += math.comb(k, agree) * p ** agree * (1 - p) ** (k - agree)
    return ((agree - 0.5) / k - chance) / (1 - chance)


def _constants(k: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    def odd(n, kind):
        return rng.integers(0, np.iinfo(kind).max, n, dtype=kind, endpoint=True) | kind(1)
    place, row_odd = odd(64, np.uint64), odd(ROWS, np.uint64)
    return odd(k, np.uint32), rng.integers(0, 2**32, k, dtype=np.uint32), row_odd, place


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles; one for the whole of a shorter text."""
    lists = [words(t) for t in texts]
    flat = [w for ws in lists for w in ws]
    if not flat:
        return [np.zeros(0, np.uint64)] * len(texts)
    codes, names = pd.factorize(np.array(flat, dtype=object))
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))[codes]
    place = _constants()[3]
    out, at = [], 0
    for ws in lists:
        n, w = len(ws), own[at:at + len(ws)]
        at += n
        k = min(n, size)
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.full(n - k + 1, np.uint64(k) * place[-1], np.uint64)
        for j in range(k):
            h += w[j:n - k + 1 + j] * place[j % 60]
        out.append(np.unique(mix64(h)))
    return out


def minima(shingles: np.ndarray, k: int) -> np.ndarray:
    """k minima of a set under as many cheap permutations of 32-bit keys."""
    times, flip, _, _ = _constants_cached(k)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(k, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(x), 1024):
        best = np.minimum(best, ((x[i:i + 1024, None] ^ flip) * times).min(axis=0))
    return best


_CACHE: dict = {}


def _constants_cached(k: int):
    if k not in _CACHE:
        _CACHE[k] = _constants(k)
    return _CACHE[k]


SIGNATURES = "doc_id long, n_shingles long, set_key binary, signature array<long>, bands array<long>"


def signatures(documents: DataFrame, shingle: int, n_bands: int) -> DataFrame:
    k = n_bands * ROWS

    def rows(batches):
        _, _, row_odd, _ = _constants_cached(k)
        shifts = (np.arange(PER_LONG) * BITS).astype(np.uint64)
        for batch in batches:
            for ids, texts in pieces(batch):
                n, keys, sigs, bands = [], [], [], []
                for s in shingle_sets(texts, shingle):
                    n.append(len(s))
                    if not len(s):
                        keys.append(None), sigs.append([]), bands.append([])
                        continue
                    m = minima(s, k)
                    low = (m & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, PER_LONG)
                    band = mix64((m.astype(np.uint64).reshape(n_bands, ROWS) * row_odd).sum(axis=1) + np.arange(n_bands, dtype=np.uint64) * row_odd[0])
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    sigs.append((low << shifts).sum(axis=1).astype(np.int64))
                    bands.append(band.view(np.int64))
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, longs),
                     pa.array(bands, longs)], names=["doc_id", "n_shingles", "set_key", "signature", "bands"])

    return documents.select(F.col("doc_id").cast("long"), utf8(F.col("text"))).mapInArrow(rows, SIGNATURES)


def full_sets(documents: DataFrame, shingle: int) -> DataFrame:
    def rows(batches):
        for batch in batches:
            for ids, texts in pieces(batch):
                sets = shingle_sets(texts, shingle)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["id", "set_key", "shingles"])

    return documents.select(F.col("doc_id").cast("long"), utf8(F.col("text"))).mapInArrow(
        rows, "id long, set_key binary, shingles array<long>")


def estimate(a: Column, b: Column, k: int) -> Column:
    """Jaccard estimate of two packed signatures, corrected for minima that agree by chance."""
    ones = sum(1 << (BITS * i) for i in range(PER_LONG))
    def differing(i: int) -> Column:
        x = F.element_at(a, i + 1).bitwiseXOR(F.element_at(b, i + 1))
        return F.bit_count(reduce(lambda p, q: p.bitwiseOR(q), [F.shiftrightunsigned(x, s) for s in range(BITS)]).bitwiseAND(F.lit(ones)))
    agree = 1 - reduce(lambda p, q: p + q, [differing(i) for i in range(k // PER_LONG)]) / k
    chance = 2.0 ** -BITS
    return (agree - chance) / (1 - chance)


def hub_pairs(rows: DataFrame, hubs: int) -> DataFrame:
    """(a, b) with a < b: each member of a bucket with a few hubs that its bucket agrees on.

    A hub is the member nearest to a fixed number by exclusive or, so it comes out of a plain minimum.
    """
    marks = [0, *np.random.default_rng(SEED + 1).integers(0, 2**62, 64).tolist()[1:hubs]]
    best = rows.groupBy("band").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi"), *[
        F.min(F.col("id").bitwiseXOR(F.lit(m))).alias(f"_h{i}") for i, m in enumerate(marks)])
    best = best.where("_lo < _hi").select(F.col("band").alias("_band"), F.array_distinct(F.array(*[
        F.col(f"_h{i}").bitwiseXOR(F.lit(m)) for i, m in enumerate(marks)])).alias("_hubs"))
    met = rows.join(best, F.col("band") == F.col("_band")).select("id", F.explode("_hubs").alias("hub")).where("id != hub")
    return met.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()


def prefix_pairs(rows: DataFrame, sets: DataFrame, threshold_percent: int) -> DataFrame:
    """(a, b) with a < b of ``rows`` (id, comp) in different components that may reach the threshold.

    Exact prefix filter: sets of sizes n and m that reach it share at least ceil(t * max(n, m)) shingles, so
    they share one among the n - ceil(t n) + 1 rarest of the one and the like of the other, and from the
    first shared one on enough must be left on both sides (positional bound). A heavily edited copy has so
    many shingles of its own that this rules out all others, however large its group; shingles whose
    holders are all in one component are dropped before the join.
    """
    own = staged(rows.join(sets.select(F.col("id").alias("_id"), "shingles"), F.col("id") == F.col("_id")).select(
        "id", "comp", "shingles"), "open-sets")
    each = own.select("id", F.explode("shingles").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).select(F.col("shingle").alias("_shingle"), "often")
    ranked = each.join(often, F.col("shingle") == F.col("_shingle")).groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("often", "shingle"))).alias("_all"))
    n = F.size("_all")
    need = F.ceil(n * F.lit(threshold_percent) / 100).cast("int")
    prefix = ranked.select(F.col("id").alias("_id"), n.alias("n"), F.posexplode(F.slice("_all", F.lit(1), n - need + 1)).alias("at", "_p"))
    prefix = prefix.where("_p.often > 1").join(own.select("id", "comp"), F.col("id") == F.col("_id")).select(
        "id", "comp", "n", "at", F.col("_p.shingle").alias("shingle"))
    prefix = staged(prefix, "prefixes")
    between = prefix.groupBy("shingle").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo < _hi").select(
        F.col("shingle").alias("_shingle"))
    prefix = prefix.join(between, F.col("shingle") == F.col("_shingle"), "left_semi")
    other = prefix.select(*[F.col(c).alias(f"_{c}") for c in prefix.columns])
    # At a pair's first shared shingle nothing before it is shared, so the rest of the shorter side must suffice.
    reach = F.least(F.col("n") - F.col("at"), F.col("_n") - F.col("_at")) * (100 + threshold_percent) >= threshold_percent * (F.col("n") + F.col("_n"))
    return prefix.join(other, (F.col("shingle") == F.col("_shingle")) & (F.col("id") < F.col("_id")) & (F.col("comp") != F.col("_comp")) & reach
                       ).select(F.col("id").alias("a"), F.col("_id").alias("b")).distinct()


def near_duplicates(documents: DataFrame, threshold_percent: int = 80, shingle: int = 5) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id (smallest id it is linked to), kept."""
    docs = documents.select("doc_id", "text")
    n_bands = bands_for(threshold_percent)
    k = n_bands * ROWS
    marked = staged(signatures(docs, shingle, n_bands), "signatures")
    classes = staged(marked.where("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(
        F.min_by(F.struct("doc_id", "n_shingles", "signature", "bands"), "doc_id").alias("_r")).select(
        "set_key", "_r.*").withColumnRenamed("doc_id", "id"), "classes")
    banded = classes.select("id", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi")).where("_lo < _hi").select(F.col("band").alias("_band"))
    live = staged(banded.join(shared, F.col("band") == F.col("_band"), "left_semi"), "buckets")
    wanted = live.select("id").distinct()
    texts = docs.join(wanted, F.col("doc_id").cast("long") == F.col("id"), "left_semi")
    known = classes.select(F.col("id").alias("_id"), F.col("set_key").alias("_key"))
    sets = staged(full_sets(texts, shingle).dropDuplicates(["id", "set_key"]).join(
        known, (F.col("id") == F.col("_id")) & (F.col("set_key") == F.col("_key")), "left_semi").select("id", "shingles"), "sets")
    sign = classes.select("id", "signature")

    def likely(pairs: DataFrame) -> DataFrame:
        """The pairs whose signatures may reach the threshold."""
        left, right = (sign.select(F.col("id").alias(f"_{s}"), F.col("signature").alias(f"_s{s}")) for s in "ab")
        return pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b")).where(
            estimate(F.col("_sa"), F.col("_sb"), k) >= lowest_estimate(threshold_percent, k)).select("a", "b")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        """Links: the pairs whose sets reach the threshold."""
        left, right = (sets.select(F.col("id").alias(f"_{s}"), F.col("shingles").alias(f"_s{s}")) for s in "ab")
        common = F.size(F.array_intersect("_sa", "_sb"))
        return staged(pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b")).where(
            100 * common >= threshold_percent * (F.size("_sa") + F.size("_sb") - common)).select("a", "b"), name)

    first = components(confirmed(likely(hub_pairs(live, HUBS)), "hub-links"), "first")
    rows = live.join(first, F.col("id") == F.col("node"), "left").select("band", "id", F.coalesce("component", "id").alias("comp"))
    open_ = rows.groupBy("band").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo < _hi").select(
        F.col("band").alias("_band"))
    rows = rows.join(open_, F.col("band") == F.col("_band"), "left_semi").select("id", "comp").distinct()
    links = confirmed(prefix_pairs(rows, sets, threshold_percent), "last-links")
    # Every node keeps one edge to its component; the last links join components.
    joined = components(first.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(links), "all")
    of_class = classes.join(joined, F.col("id") == F.col("node"), "left").select(
        F.col("set_key").alias("_key"), F.coalesce("component", "id").alias("_component"))
    of_class = of_class.groupBy("_key").agg(F.min("_component").alias("_component"))
    out = marked.select("doc_id", "n_shingles", "set_key").join(of_class, F.col("set_key") == F.col("_key"), "left")
    component = F.coalesce("_component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def without_duplicates(documents: DataFrame, threshold_percent: int = 80, shingle: int = 5) -> DataFrame:
    """The rows of ``documents`` that are kept: one of each group.

    Where ids repeat, a row's identity is its id and text: rows that share an id but no likeness all stay,
    rows equal in both are one (whichever, should other columns differ), and of a group the first by id and text digest stays.
    Rows without an id all stay.
    """
    known = documents.where("doc_id is not null")
    if known.groupBy(F.col("doc_id").cast("long")).count().where("count > 1").isEmpty():
        found = near_duplicates(documents, threshold_percent, shingle)
        gone = staged(found.where("not kept").select(F.col("doc_id").alias("_gone")), "near-duplicates")
        return documents.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
    identity = [F.col("doc_id").cast("long").alias("_own_id"), F.coalesce(F.md5("text"), F.lit("")).alias("_own_text")]
    numbers = numbered(known.select(*identity).distinct(), [F.col("_own_id"), F.col("_own_text")], "row-identities").select(
        F.col("_own_id").alias("_id"), F.col("_own_text").alias("_digest"), F.col("_rank").alias("_identity_row"))
    named = staged(documents.select("*", *identity).join(numbers, (F.col("_own_id") == F.col("_id")) & (F.col("_own_text") == F.col("_digest")), "left").select(
        *documents.columns, "_identity_row"), "numbered-rows")
    found = near_duplicates(named.where("_identity_row is not null").select(F.col("_identity_row").alias("doc_id"), "text"), threshold_percent, shingle)
    gone = staged(found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "near-duplicates")
    rows = named.where("_identity_row is not null").join(gone, F.col("_identity_row") == F.col("_gone"), "left_anti").dropDuplicates(["_identity_row"])
    return rows.unionByName(named.where("_identity_row is null")).select(*documents.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), threshold_percent=85, shingle=3)


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS reach FROM documents UNION SELECT node, b FROM r JOIN e ON a = reach),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN c ON node = d.doc_id LEFT JOIN n USING (doc_id)
"""
