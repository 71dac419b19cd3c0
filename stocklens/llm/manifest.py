"""A Merkle manifest of a dataset: one root for all rows, and a proof for each row, from few stored levels.

A leaf is the sha256 of a row's fields, each with its byte count ahead, so no two rows run into one another. Per
group (source) the leaves stand in order of id, and every 16 consecutive nodes become the sha256 of their hex digests
run together, until one is left, the group's subroot. The subroots, in order of their group, grow into the root likewise.

Checkpoint and recompute: only every second level is stored (``SPAN``), as one row per aligned subtree: the up to 256 nodes of the
stored level below one node of the next. Growing a level hashes each row's missing interior nodes on the fly and keeps
the top alone. Proof extraction goes down from the root: a stored row meets the proof of its top node, hashes the
missing level again, and emits for each of its nodes the siblings on both levels followed by the proof of the top;
the interior nodes are gone with the row. So nothing is gathered beyond 256 nodes, the rows dealt by (group,
subtree) spread a group of any size, and all levels above the leaves hold less than a hundredth of them.

A proof is an array of steps, lowest first: the digests left and right of the node within its run, each run
together. A run of one node has a step with neither, since it is hashed too; a level of one node has none.

Nulls and ties: a null field is ``-`` within the leaf; a null group is a group of its own and comes first; null ids come first within
theirs; rows with equal ids follow their leaves, so repeated rows are a leaf each and reruns agree. An empty table has no rows and no root. Extra columns
are neither hashed nor carried, whatever their names. A very long text is hashed as one value within its row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.common import drop_staged, lower_ascii, staged, table

#: Nodes in a run are 2**4; levels per stored one. A stored row holds 2**(4 * 2) nodes at most.
BITS, SPAN = 4, 2
RUN, ROW_BITS = 1 << BITS, BITS * SPAN
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of texts run together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value's byte count, a colon and the value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def _levels_size(size: Column, level: int) -> Column:
    """Nodes on a level above ``size`` leaves."""
    return F.shiftright(size + ((1 << (BITS * level)) - 1), BITS * level)


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``at`` (place from 0 within the row's ``tree``) and ``size`` (rows of that tree).

    Rows are dealt by range, so a tree is spread over tasks however large it is; each task counts its own, and one row per
    task and tree gives the offsets. Both passes read the same stored rows.
    """
    dealt = staged(rows.repartitionByRange("tree", *order).withColumn("_part", F.spark_partition_id()), f"{name}-dealt")
    counts = dealt.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("tree")
    offsets = counts.select(F.col("tree").alias("_tree"), F.col("_part").alias("_of"), F.sum("_n").over(whole).alias("size"), (F.sum("_n").over(
        whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("_part", "tree").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(inside))
    out = ranked.join(offsets, (F.col("_part") == F.col("_of")) & (F.col("tree") == F.col("_tree")))
    return out.select(*rows.columns, (F.col("_rank") - 1 + F.col("_before")).alias("at"), "size")


def _stored(nodes: DataFrame, name: str) -> DataFrame:
    """Nodes (tree, at, size, digest, item) as one row per aligned subtree: (tree, at, size, nodes)."""
    node = F.struct("at", "digest", "item")
    return staged(nodes.groupBy("tree", F.shiftright("at", ROW_BITS).alias("at")).agg(
        F.max("size").alias("size"), F.sort_array(F.collect_list(node)).alias("nodes")), name)


def _regrown(rows: DataFrame, level: int) -> DataFrame:
    """Stored rows with ``digests``, the missing level above them (``middle``), and the node counts of both levels."""
    df = rows.withColumns({"digests": F.transform("nodes", lambda x: x["digest"]),
                           "n_low": _levels_size(F.col("size"), level), "n_middle": _levels_size(F.col("size"), level + 1)})
    runs = F.sequence(F.lit(0), F.shiftright(F.size("digests") - 1, BITS))
    return df.withColumn("middle", F.transform(runs, lambda r: digest(_joined(F.slice("digests", r * RUN + 1, RUN)))))


class Grown(NamedTuple):
    """The stored levels of all trees, leaves first, and each tree's top as (tree, digest)."""
    levels: list[DataFrame]
    tops: DataFrame

    def drop(self) -> None:
        """Delete the stored levels; nothing that reads them works afterwards."""
        for rows in self.levels:
            drop_staged(rows)


def grow(nodes: DataFrame, name: str) -> Grown:
    """Store every second level above ``nodes`` (tree, at, size, digest, item)."""
    levels = [_stored(nodes, f"{name}-0")]
    largest = levels[0].agg(F.max("size")).first()[0] or 0
    while True:
        depth = len(levels) - 1
        top = (F.when(F.col("n_middle") > 1, digest(_joined(F.col("middle"))))
               .when(F.col("n_low") > 1, F.get("middle", F.lit(0))).otherwise(F.get("digests", F.lit(0))))
        tops = _regrown(levels[-1], depth * SPAN).select("tree", "at", "size", top.alias("digest"), F.lit(None).cast("string").alias("item"))
        if largest <= 1 << (ROW_BITS * (depth + 1)):
            return Grown(levels, tops.select("tree", "digest"))
        levels.append(_stored(tops, f"{name}-{depth + 1}"))


STEP = "array<struct<left:string,right:string>>"


def _step(run: Column, i: Column) -> Column:
    """What stands left and right of node ``i`` in its run."""
    return F.struct(_joined(F.slice(run, 1, i)).alias("left"), _joined(F.slice(run, i + 2, RUN)).alias("right"))


def proofs(levels: list[DataFrame], tails: DataFrame) -> DataFrame:
    """A row per leaf: tree, at, digest, item, steps up to the end of its tail, and the tail's ``top``.

    ``tails`` has one row per tree: tree, steps from the tree's top upwards, and any struct ``top`` to carry along.
    """
    above = tails.select("tree", F.lit(0).cast("long").alias("at"), "steps", "top")
    for depth in range(len(levels) - 1, -1, -1):
        met = _regrown(levels[depth], depth * SPAN).join(above, ["tree", "at"])

        def steps(i: Column) -> Column:
            run = F.shiftright(i, BITS)
            low = F.when(F.col("n_low") > 1, F.array(_step(F.slice("digests", run * RUN + 1, RUN), i % RUN)))
            middle = F.when(F.col("n_middle") > 1, F.array(_step(F.col("middle"), run)))
            none = F.array().cast(STEP)
            return F.concat(F.coalesce(low, none), F.coalesce(middle, none), F.col("steps"))

        each = F.transform("nodes", lambda x, i: F.struct(
            x["at"].alias("at"), x["digest"].alias("digest"), x["item"].alias("item"), steps(i).alias("steps")))
        above = met.select("tree", "top", F.inline(each))
    return above


def folded(start: Column, steps: Column) -> Column:
    """The root that follows from a leaf's digest and its steps."""
    return F.aggregate(steps, start, lambda node, s: digest(s["left"], node, s["right"]))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(_joined(F.transform(steps, lambda s: F.concat(s["left"], s["right"]))))


class Manifest(NamedTuple):
    """``groups``: the leaves' trees, one per group; ``total``: the tree over their subroots, whose only top is the root."""
    groups: Grown
    total: Grown

    def subroots(self) -> DataFrame:
        """source and subroot of each group."""
        return self.groups.tops.select(F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("source"),
                                       F.col("digest").alias("subroot"))

    def proofs(self) -> DataFrame:
        """item, digest, steps, subroot and root of every leaf."""
        start = self.total.tops.select("tree", F.array().cast(STEP).alias("steps"), F.struct(F.col("digest").alias("root")).alias("top"))
        groups = proofs(self.total.levels, start).select(
            F.col("item").alias("tree"), "steps", F.struct(F.col("digest").alias("subroot"), F.col("top")["root"].alias("root")).alias("top"))
        return proofs(self.groups.levels, groups).select("item", "digest", "steps", "top.subroot", "top.root")


def manifest(rows: DataFrame, group: str, order: list[str], name: str = "manifest") -> Manifest:
    """The manifest of ``rows``, which have a group, columns to order by within it, a ``digest`` and an ``item`` to carry."""
    # Ahead of all groups stands the null group; a mark keeps it apart from a group whose name is empty.
    keyed = rows.withColumn("tree", F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("")))
    keyed = keyed.select("tree", "digest", "item", *[F.col(c).alias(f"_order_{c}") for c in order])
    groups = grow(placed(keyed, [c for c in keyed.columns if c.startswith("_order_")] + ["digest"], name), name)
    tops = groups.tops.select(F.lit("").alias("tree"), F.col("digest"), F.col("tree").alias("item"))
    return Manifest(groups, grow(placed(tops, ["item"], f"{name}-groups"), f"{name}-groups"))


def document_leaves(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """source, doc_id, digest and item (doc_id, offered) of each row; ``offered`` is the leaf with the text lower-cased where ``tampered``."""
    fields = [F.col(c) for c in FIELDS]
    made = leaf(*fields)
    other = leaf(*fields[:-1], lower_ascii(F.col("text")))
    offered = made if tampered is None else F.when(tampered, other).otherwise(made)
    df = documents.select("source", F.col("doc_id").cast("long").alias("doc_id"), made.alias("digest"), offered.alias("offered"))
    return df.select("source", "doc_id", "digest", F.struct("doc_id", "offered").alias("item"))


def query(spark, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    rows = document_leaves(table(spark, sf_dir, "documents"), tampered)
    proven = manifest(rows, "source", ["doc_id"]).proofs()
    root = folded(F.col("item.offered"), F.col("steps"))
    return proven.select(F.col("item.doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
                         proof_digest(F.col("steps")).alias("proof_sha256"), root.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def _grown_sql(name: str, start: str) -> str:
    """Recursive table of all nodes (tree, lvl, place, h) above ``start``."""
    return f"""{name}(tree, lvl, place, h) AS (
    SELECT tree, 0, place, h FROM {start}
    UNION ALL
    SELECT tree, lvl + 1, place // 16, sha256(string_agg(h, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1 GROUP BY tree, lvl, place // 16)"""


#: crc32 is not among DuckDB's functions, so the tampered rows come from a table of its 256 entries built here by its rule.
SQL = f"""
WITH RECURSIVE crc_table(i, c, k) AS (
    SELECT i::UBIGINT, i::UBIGINT, 0 FROM range(256) AS r(i)
    UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END, k + 1 FROM crc_table WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS t FROM crc_table WHERE k = 8),
docs AS (SELECT *, row_number() OVER () AS r FROM documents),
crc(r, rest, c) AS (
    SELECT r, doc_id::VARCHAR, 4294967295::UBIGINT FROM docs WHERE doc_id IS NOT NULL
    UNION ALL SELECT r, rest[2:], xor(t[(xor(c, ascii(rest[1])::UBIGINT) % 256 + 1)::BIGINT], c // 256) FROM crc, steps WHERE rest <> ''),
fields AS (
    SELECT r, doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
           coalesce(strlen(text) || ':' || text, '-') AS body,
           coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lowered FROM docs),
leaf AS (
    SELECT r, doc_id, coalesce('s' || source, '') AS tree, sha256(head || body) AS h,
           CASE WHEN xor(c, 4294967295::UBIGINT) % 5 = 0 THEN sha256(head || lowered) ELSE sha256(head || body) END AS offered
    FROM fields LEFT JOIN (SELECT r, c FROM crc WHERE rest = '') USING (r)),
base AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS place FROM leaf),
{_grown_sql("node", "base")},
sub AS (SELECT tree, h AS subroot FROM node QUALIFY row_number() OVER (PARTITION BY tree ORDER BY lvl DESC) = 1),
sub_at AS (SELECT tree AS name, subroot, '' AS tree, subroot AS h, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM sub),
{_grown_sql("upper", "sub_at")},
root AS (SELECT h AS root FROM upper ORDER BY lvl DESC LIMIT 1),
level_size AS (SELECT tree, lvl, count(*) AS n FROM node GROUP BY ALL), upper_size AS (SELECT lvl, count(*) AS n FROM upper GROUP BY ALL),
step AS (
    SELECT r, s.lvl, coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place < b.place >> (4 * s.lvl)), '') AS l,
           coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place > b.place >> (4 * s.lvl)), '') AS g
    FROM base b JOIN level_size s ON s.tree = b.tree AND s.n > 1
    JOIN node n ON n.tree = b.tree AND n.lvl = s.lvl AND n.place // 16 = b.place >> (4 * s.lvl + 4) GROUP BY r, s.lvl
    UNION ALL
    SELECT r, 100 + s.lvl, coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place < b.place >> (4 * s.lvl)), ''),
           coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place > b.place >> (4 * s.lvl)), '')
    FROM base JOIN sub_at b ON b.name = base.tree JOIN upper_size s ON s.n > 1
    JOIN upper n ON n.lvl = s.lvl AND n.place // 16 = b.place >> (4 * s.lvl + 4) GROUP BY r, s.lvl),
proof AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY lvl) AS k, l, g FROM step),
fold(r, k, h) AS (SELECT r, 0, offered FROM leaf UNION ALL
    SELECT r, p.k, sha256(l || h || g) FROM fold f JOIN proof p USING (r) WHERE p.k = f.k + 1)
SELECT doc_id, base.h AS leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM base JOIN sub USING (tree) CROSS JOIN root
LEFT JOIN (SELECT r, string_agg(l || g, '' ORDER BY k) AS siblings FROM proof GROUP BY r) USING (r)
JOIN (SELECT r, h FROM fold QUALIFY row_number() OVER (PARTITION BY r ORDER BY k DESC) = 1) f USING (r)
"""
