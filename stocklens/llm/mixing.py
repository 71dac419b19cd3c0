"""Mixing sources to target weights, with DataFrame functions only.

1. Sizes: words per document, summed per source (map-side combine, one row per source).
2. Targets: sources in code point order, null last, weigh 3, 1, 2 in turn and share ``share`` times
   all words by weight; a target stops at ``most`` times its source's size and the excess is shared
   again by weight until none is above (each round is one aggregate over the sources).
3. Quotas: the targets are cut into equal blocks of ``block`` words, and the blocks of the whole mix
   are allocated to sources by highest Sainte-Lague quotients target / (2k + 1), then within a
   source to its shards by theirs. Most seats follow from the exact share; only the few quotients
   around it are listed and ranked, five or so per source or shard.
4. Selection: a shard holds about ``shard_words`` words, so a hot source has many. Within a shard
   documents follow a seeded order and form one stream of blocks. A quota takes the whole stream as
   often as it fits, and then one more run of blocks that starts at a seeded block and wraps round.
   What a document gives is the overlap of its words with that run, so no block is ever a row.

Nulls and ties: a null text has no words; a null source is a source of its own, last in order; rows
with equal ids are told apart by the hash of their text and otherwise interchangeable. Without
words all targets and takes are 0. Reruns with the same seed agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.common import WORD, numbered, staged, table

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
BLOCK, SHARD_WORDS, SHARD_ROWS, SEED = 4, 500_000, 5_000, 17


def n_words(text: Column) -> Column:
    """Number of words between blanks, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST,
                   weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Per source: source, source_size, rows, target.

    A source is capped once ``level * weight`` reaches its cap, where ``level`` is what is left per
    weight of the uncapped ones. The level only rises from round to round and every round but the
    last caps a source, so this ends.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    per = numbered(per, [F.col("source").asc_nulls_last()], "sources").drop("_before")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = staged(per.withColumns({"weight": weight, "cap": F.col("source_size") * most}), "source-weights")
    total = (per.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        capped = F.col("weight") * level > F.col("cap")
        full, free = per.agg(F.sum(F.when(capped, F.col("cap"))), F.sum(F.when(~capped, F.col("weight")))).first()
        new = (total - (full or 0.0)) / free if free else level
        if new <= level:
            break
        level = new
    return per.select("source", "source_size", "rows",
                      F.when(F.col("source_size") == 0, 0.0).otherwise(F.least(F.col("weight") * level, "cap")).alias("target"))


def sainte_lague(units: DataFrame, votes: str, seats: Column, order: list[str], name: str,
                 group: list[str] | None = None) -> DataFrame:
    """Add ``quota``: the integer seats of each unit among those of its group, by highest quotients.

    With V votes, S seats and n units in a group, the final divisor lies between V / (S + n/2) and
    V / (S - n/2), so a unit with share p gets between p (S - n/2) - 1/2 and p (S + n/2) + 1/2
    seats. The lower bound is given at once, and only the quotients up to the upper one are ranked.
    Ties go to the earlier unit in ``order``. ``seats`` is the group's number, the same in its rows.
    """
    group = group or []
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    p = F.when(F.col("_v") > 0, F.col(votes) / F.col("_v")).otherwise(0.0)
    half = p * F.col("_n") / 2 + 0.5
    ideal = p * F.col("_s")
    base = staged(units.withColumn("_s", seats.cast("double")).withColumns(
        {"_v": F.sum(votes).over(whole).cast("double"), "_n": F.sum(F.when(F.col(votes) > 0, 1).otherwise(0)).over(whole)})
        .withColumns({"_low": F.greatest(F.lit(0.0), F.floor(ideal - half)).cast("long"),
                      "_high": F.when(p > 0, F.ceil(ideal + half)).otherwise(0).cast("long")})
        .withColumn("_left", (F.col("_s") - F.sum("_low").over(whole)).cast("long")), f"{name}-units")
    listed = base.where("_high > _low").select(*group, *order, "_left", F.explode(F.sequence("_low", F.col("_high") - 1)).alias("_k"),
                                               votes).withColumn("_q", F.col(votes) / (2 * F.col("_k") + 1))
    ranked = numbered(listed, [F.col("_q").desc(), *[F.col(o).asc_nulls_last() for o in order]], f"{name}-quotients", group)
    keys = [*group, *order]
    won = ranked.where("_rank <= _left").groupBy(*keys).agg(F.count(F.lit(1)).alias("_won"))
    won = won.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_won")
    on = [base[k].eqNullSafe(won[f"_k{i}"]) for i, k in enumerate(keys)]
    return base.join(won, on, "left").select(*units.columns,
                                             (F.col("_low") + F.coalesce("_won", F.lit(0))).alias("quota"))


def mix(documents: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[float, ...] = WEIGHTS,
        block: int = BLOCK, shard_words: int = SHARD_WORDS, shard_rows: int = SHARD_ROWS, seed: int = SEED) -> DataFrame:
    """Per document row: doc_id, text_hash, size, source, source_size, target, and what the mix takes.

    ``passes`` is how often it takes the whole document, ``runs`` the word spans (start, end) that it
    takes once more, ``taken`` the words in all.
    """
    rows = staged(documents.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                                   F.xxhash64("text").alias("text_hash")), "sizes")
    targets = staged(source_targets(rows, share, most, weights), "targets")
    # A source's shards, enough for its words and its rows.
    shards_of = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("rows") / shard_rows)).cast("long")
    sides = targets.select(F.col("source").alias("_source"), "source_size", "target", shards_of.alias("shards"))
    placed = rows.join(sides, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = placed.withColumns({"_mixed": F.xxhash64(F.lit(seed), "doc_id", "text_hash"),
                                 "shard": F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text_hash"), F.col("shards"))})
    shard_key = ["source", "shard"]
    shards = placed.groupBy(*shard_key).agg(F.sum("size").alias("shard_words"), F.first("target").alias("target"))

    total = targets.agg(F.sum("target")).first()[0] or 0.0
    seats = sainte_lague(targets, "target", F.lit(round(total / block)), ["source"], "sources")
    seats = seats.select(F.col("source").alias("_source"), F.col("quota").alias("source_quota"))
    shards = shards.join(seats, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    quotas = staged(sainte_lague(shards, "shard_words", F.col("source_quota"), ["shard"], "shards", ["source"]), "quotas")

    n_blocks = F.ceil(F.col("shard_words") / block).cast("long")
    quotas = quotas.withColumn("quota", F.least("quota", F.floor(n_blocks * most).cast("long")))
    quotas = quotas.where("shard_words > 0").select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "shard_words", "quota",
        F.floor(F.col("quota") / n_blocks).alias("passes"), F.pmod("quota", n_blocks).alias("extra"), n_blocks.alias("n_blocks"),
        F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), n_blocks).alias("first_block"))
    before = Window.partitionBy(*shard_key).orderBy("_mixed", "doc_id", "size", "text_hash").rowsBetween(
        Window.unboundedPreceding, -1)
    streamed = placed.withColumn("_from", F.coalesce(F.sum("size").over(before), F.lit(0)))
    joined = streamed.join(quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")), "left")
    # A shard's last block may be short, so a quota beyond all blocks twice stays within twice the words.
    start = F.col("first_block") * block
    end = start + F.col("extra") * block
    stop = F.col("n_blocks") * block
    lo, hi = F.col("_from"), F.col("_from") + F.col("size")

    def overlap(a: Column, b: Column) -> Column:
        left, right = F.greatest(lo, a), F.least(hi, b)
        return F.when(right > left, F.struct((left - lo).cast("long").alias("start"), (right - lo).cast("long").alias("end")))

    wrapped = overlap(F.lit(0).cast("long"), F.least(end - stop, start))
    straight = overlap(start, F.least(end, stop))
    runs = F.array_compact(F.array(wrapped, straight))
    out = joined.select("doc_id", "text_hash", "size", "source", "source_size", "target",
                        F.coalesce("passes", F.lit(0)).cast("long").alias("passes"),
                        F.when(F.col("_source").isNotNull() | F.col("passes").isNotNull(), runs).alias("runs"))
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    out = out.withColumn("runs", F.coalesce("runs", empty))
    extra = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return out.withColumn("taken", F.col("passes") * F.col("size") + extra)


def mixed_texts(documents: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``documents``: a row per time a document is taken.

    A whole pass keeps the text as it is; a further run keeps its words and the blanks among them.
    """
    taken = staged(mix(documents, **options).where("taken > 0"), "taken")
    counted = taken.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
                           *[F.col(c).alias(f"_{c}") for c in ("size", "passes", "runs")])
    distinct = documents.withColumn("_text_hash", F.xxhash64("text"))
    if not taken.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        distinct = distinct.dropDuplicates(["doc_id", "_text_hash"])  # each copy has its own takes
    both = distinct.join(counted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")))
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("start"), F.col("_size").alias("end")), F.col("_passes").cast("int"))
    rows = both.withColumn("_run", F.explode(F.concat(whole, "_runs")))
    piece = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    span = F.col("_run.end") - F.col("_run.start")
    cut = F.regexp_replace(F.array_join(F.slice(piece, (F.col("_run.start") + 1).cast("int"), span.cast("int")), ""),
                           r"^[\x20\x09-\x0D]+", "")
    text = F.when((F.col("_run.start") == 0) & (F.col("_run.end") == F.col("_size")), F.col("text")).otherwise(cut)
    columns = [text.alias(c) if c == "text" else F.length(text).cast("long").alias(c) if c == "n_chars" else F.col(c)
               for c in documents.columns]
    return rows.select(*columns)


def query(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
