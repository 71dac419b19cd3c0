"""The Merkle manifest against a tree grown node by node."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stocklens.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(leaves):
    """Levels of digests, leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain_steps(levels, at):
    for level in levels[:-1]:
        first = at // 16 * 16
        yield "".join(level[first:at]), "".join(level[at + 1:first + 16])
        at //= 16


def plain_rows(docs):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of each row, sorted."""
    groups = defaultdict(list)
    for doc_id, source, lang, n_chars, text in docs:
        low = text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        made = plain_leaf(doc_id, source, lang, n_chars, text)
        offered = plain_leaf(doc_id, source, lang, n_chars, low) if hit else made
        groups[source].append((doc_id is not None, doc_id or 0, made, offered, doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(groups[s])]) for s in names}
    upper = plain_tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (*_, made, offered, doc_id) in enumerate(sorted(groups[s])):
            steps = [*plain_steps(trees[s], at), *plain_steps(upper, k)]
            node = offered
            for left, right in steps:
                node = h(left, node, right)
            out.append((doc_id, made, trees[s][-1][0], upper[-1][0], h(*[a + b for a, b in steps]), node, node == upper[-1][0]))
    return sorted(out, key=str)


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def asked(spark, tmp_path, docs):
    path = str(tmp_path / "in")
    # Clashing names: none of the operator's helper columns may meet them.
    frame = spark.createDataFrame(docs, COLUMNS).withColumns(
        {c: F.lit(7) for c in ("at", "tree", "size", "digest", "item", "steps", "_part", "top")})
    frame.repartition(5).write.parquet(f"{path}/documents.parquet")
    got = manifest.query(spark, path)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.select(*names).collect()), key=str)


def test_awkward_rows(spark, tmp_path):
    docs = [(1, "a", "en", 5, "Hello"), (2, "a", "en", 0, ""), (3, "a", None, None, None), (None, "a", "en", 3, "No id"),
            (4, None, "en", 3, "abc"), (4, None, "en", 3, "abc"), (4, None, "en", 3, "ABD"), (5, "", "x", 1, "é"), (6, "z", "x", 1, "Z" * 100_000),
            (-7, "é", "fr", 2, "ÀB"), (10, "a:1", "1:a", 1, "3:a"), (13, "a", "en", 9, "Tampered"), (20, "a", "en", 8, "SHOUTING")]
    got = asked(spark, tmp_path, docs)
    assert got == plain_rows(docs)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("n", [1, 16, 17, 256, 257, 4500])
def test_trees_of_all_heights(spark, tmp_path, n):
    rnd = random.Random(n)
    docs = [(i, "hot", "en", i % 7, f"Text {rnd.random()}") for i in range(n)] + [(10_000 + i, f"s{i:03}", "en", 1, "x") for i in range(min(n, 20) - 1)]
    assert asked(spark, tmp_path, docs) == plain_rows(docs)


def test_no_rows(spark, tmp_path):
    assert asked(spark, tmp_path, []) == []


def test_few_levels_are_stored(spark):
    rows = spark.range(5000).select(F.lit("g").alias("source"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("digest"),
                                    F.struct("id").alias("item"))
    made = manifest.manifest(rows, "source", ["doc_id"], "test-manifest")
    assert [r.select(F.sum(F.size("nodes"))).first()[0] for r in made.groups.levels] == [5000, 20]
    assert made.groups.levels[0].agg(F.max(F.size("nodes"))).first()[0] == 256
    assert made.subroots().collect()[0][1] == plain_tree([h(str(i)) for i in range(5000)])[-1][0]
    made.groups.drop()
    made.total.drop()
