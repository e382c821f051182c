"""Mixing sources to target weights: packed blocks, drawn slots, permuted indices, one join.

Every source is one stream of words, packed into blocks of fixed length.  The mix is a
row of equal slots, dealt to output shards.  Each slot draws its source by weight, so a
shard's source counts are multinomial; slots that a source has drawn beyond its quota
over the whole mix go to the sources that drew too few.  A source's j-th slot takes the
block at place j mod n of pseudorandom permutation number j div n of its n blocks, so
every block is used once before any is used again.  Slots and blocks meet in one join on
(source, block).

Nothing is gathered by source: streams are measured in buckets of documents, draws are
counted per shard before anything is numbered, and only tables with one row per source,
per (source, bucket) or per (source, shard) are ordered by source.

Defined results: NULL text has no words and is never taken, nor is a text without words;
a NULL source is a source of its own, after all others; rows with equal or NULL doc_id
are separate documents; an empty table, or one without words, gives an empty mix; ties
do not matter, as documents are ordered by (bucket, doc_id, text hash); other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from dqgate.llm.common import WORD, computed, numbered, ranked, restored, written


@dataclass(frozen=True)
class Mix:
    """Parameters of a mix.  ``weights`` repeat over the sources in code point order."""

    weights: Sequence[int] = (1, 2, 3)
    max_repeats: int = 3
    block_words: int = 64
    shard_slots: int = 4096
    buckets: int = 4096
    rounds: int = 24
    seed: int = 20


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, text, size, text_hash``; ``size`` is the number of words."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", "text", size.alias("size"), F.xxhash64("text").alias("text_hash"))


def source_targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``source, source_size, target`` from rows of (source, size).

    The whole size is shared by weight.  A target stops at ``max_repeats`` times the
    source's size, and what is above is shared again among the others, until none is
    above.  The shares of a round differ by one number only, the size per weight, so a
    round is one aggregate of two sums; there are at most as many rounds as sources that
    stop, usually two or three.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = totals.select("*", F.col("source").isNull().alias("_last"))
    weights = F.array(*[F.lit(int(w)) for w in mix.weights])
    weighted = written(
        ranked(order, ["_last", "source"], "_place").select(
            "source", "source_size",
            F.element_at(weights, (F.col("_place") % len(mix.weights) + 1).cast("int")).alias("weight"),
        )
    )
    cap = F.col("source_size") * mix.max_repeats
    whole = weighted.agg(F.sum("source_size")).first()[0] or 0
    left, over = whole, -1
    open_weight = weighted.agg(F.sum("weight")).first()[0] or 1
    while True:
        # left / open_weight is the size per weight; compared in whole numbers.
        stops = F.lit(left).cast("decimal(38,0)") * F.col("weight") > cap.cast("decimal(38,0)") * open_weight
        found = weighted.agg(
            F.count(F.when(stops, 1)), F.sum(F.when(stops, cap)), F.sum(F.when(~stops, F.col("weight")))
        ).first()
        if found[0] == over or found[2] is None:
            break
        over, left, open_weight = found[0], whole - (found[1] or 0), found[2]
    share = F.lit(left).cast("double") * F.col("weight") / F.lit(open_weight)
    return weighted.select("source", "source_size", F.when(stops, cap.cast("double")).otherwise(share).alias("target"))


def packed(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``rows`` of :func:`sized` with ``start``, their place in the stream of their source.

    Documents are dealt to buckets by hash; the size of a bucket is summed before the
    buckets of a source are added up, and places within a bucket are a running sum.
    """
    bucket = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(mix.seed)), F.lit(mix.buckets))
    keyed = rows.where("size > 0").withColumn("_bucket", bucket)
    sums = keyed.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("source", "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = (
        Window.partitionBy("source", "_bucket").orderBy("doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = keyed.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.alias("p").join(
        base.alias("b"),
        F.col("p.source").eqNullSafe(F.col("b.source")) & (F.col("p._bucket") == F.col("b._bucket")),
    )
    return joined.select(*[F.col(f"p.{c}") for c in rows.columns], (F.col("_base") + F.col("_in")).alias("start"))


def quotas(targets: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``targets`` with ``blocks`` (of the source's stream) and ``quota`` (slots it fills)."""
    blocks = F.ceil(F.col("source_size") / mix.block_words).cast("long")
    quota = F.round(F.col("target") * blocks / F.col("source_size")).cast("long")
    return targets.where("source_size > 0").select("*", blocks.alias("blocks"), quota.alias("quota"))


def drawn_slots(quota: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``shard, slot, source, turn``: every slot of the mix and which of its source's turns it is.

    Slots draw sources independently, with probabilities in proportion to the quotas.
    """
    spark = quota.sparkSession
    ordered = ranked(quota.select("*", F.col("source").isNull().alias("_last")), ["_last", "source"], "sid")
    earlier = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    sources = written(ordered.withColumn("lo", F.coalesce(F.sum("quota").over(earlier), F.lit(0))))
    n = sources.agg(F.sum("quota")).first()[0] or 0
    # A draw is a number below n; ``_cell`` cuts [0, n) so that draws meet few sources each.
    cell = max(1, n // 4096)
    spans = sources.where("quota > 0").select(
        "sid", "lo", (F.col("lo") + F.col("quota")).alias("hi"),
        F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor((F.col("lo") + F.col("quota") - 1) / cell))).alias("_cell"),
    )
    draws = spark.range(n).select(
        F.col("id").alias("_slot"),
        F.pmod(F.xxhash64("id", F.lit(mix.seed)), F.lit(max(1, n))).alias("_draw"),
    ).withColumn("_cell", F.floor(F.col("_draw") / cell))
    drawn = draws.join(spans, "_cell").where("_draw >= lo and _draw < hi").select(
        F.floor(F.col("_slot") / mix.shard_slots).alias("shard"), "_slot", "sid"
    )
    drawn = written(drawn)

    counts = drawn.groupBy("sid", "shard").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("sid", "shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("sid", "shard").orderBy("_slot")
    turns = (
        drawn.withColumn("_in", F.row_number().over(inside) - 1)
        .join(base, ["sid", "shard"])
        .select("shard", "_slot", "sid", (F.col("_base") + F.col("_in")).alias("turn"))
    )
    totals = counts.groupBy("sid").agg(F.sum("_n").alias("_drawn"))
    state = sources.join(totals, "sid", "left").select("sid", "quota", F.coalesce("_drawn", F.lit(0)).alias("_drawn"))
    up_to = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    state = written(
        state.select(
            "sid", "quota", "_drawn",
            F.coalesce(F.sum(F.greatest(F.col("_drawn") - F.col("quota"), F.lit(0))).over(up_to), F.lit(0)).alias("_over"),
            F.coalesce(F.sum(F.greatest(F.col("quota") - F.col("_drawn"), F.lit(0))).over(up_to), F.lit(0)).alias("_under"),
        )
    )
    # Slots beyond a quota are numbered through, and so are the turns that nobody drew.
    known = turns.join(state, "sid")
    beyond = known.where("turn >= quota").select("shard", "_slot", (F.col("_over") + F.col("turn") - F.col("quota")).alias("_x"))
    free = state.where("_drawn < quota").select("sid", F.posexplode(F.sequence("_drawn", F.col("quota") - 1)).alias("_i", "turn"), "_under")
    settled = beyond.join(free.select("sid", "turn", (F.col("_under") + F.col("_i")).alias("_x")), "_x")
    slots = known.where("turn < quota").select("shard", "_slot", "sid", "turn").unionByName(
        settled.select("shard", "_slot", "sid", "turn")
    )
    return slots.join(sources.select("sid", "source", "blocks"), "sid").select(
        "shard", (F.col("_slot") % mix.shard_slots).alias("slot"), "source", "blocks", "turn"
    )


def permuted(place: Column, n: Column, key: Column, mix: Mix = Mix()) -> Column:
    """Where ``place`` goes in the pseudorandom permutation of 0..n-1 chosen by ``key``.

    Swap or not: in each round a place has one partner, and a bit that both compute
    alike decides whether they change places.  A permutation for any n, without search.
    """

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        bit = F.pmod(F.xxhash64(key, r, F.greatest(x, partner)), F.lit(2)) == 1
        return F.when(bit, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(mix.rounds)), place, swap)


def taken_blocks(slots: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``shard, slot, source, block, epoch``: which block of its source fills each slot."""
    epoch = F.floor(F.col("turn") / F.col("blocks"))
    place = F.col("turn") % F.col("blocks")
    block = permuted(place, F.col("blocks"), F.xxhash64("source", epoch, F.lit(mix.seed)), mix)
    return slots.select("shard", "slot", "source", block.alias("block"), epoch.alias("epoch"))


def pieces(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Packed ``rows`` cut at block borders: plus ``block``, ``first`` word and ``words``."""
    b = mix.block_words
    last = F.floor((F.col("start") + F.col("size") - 1) / b)
    cut = rows.select("*", F.explode(F.sequence(F.floor(F.col("start") / b), last)).alias("block"))
    first = F.greatest(F.col("block") * b - F.col("start"), F.lit(0))
    end = F.least((F.col("block") + 1) * b - F.col("start"), F.col("size"))
    return cut.select("*", first.alias("first"), (end - first).alias("words"))


def _prepared(docs: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes without texts (written, so that texts are read once), targets, taken blocks."""
    sizes = written(sized(docs).drop("text"))
    targets = written(source_targets(sizes, mix))
    return sizes, targets, taken_blocks(drawn_slots(quotas(targets, mix), mix), mix)


def mixed_blocks(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as an index: ``shard, slot, source, block, epoch, doc_id, text_hash, first, words``.

    One row per piece of a document in a slot: its ``words`` words from ``first`` on.
    """
    sizes, _, taken = _prepared(docs, mix)
    return _meet(taken, pieces(packed(sizes, mix), mix)).select(
        "t.shard", "t.slot", "t.source", "t.block", "t.epoch", "c.doc_id", "c.text_hash", "c.first", "c.words"
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents: a row for each document and epoch, with the words taken then.

    All columns of ``docs`` stay; ``n_chars``, where there is such a column, is counted
    again.  Texts are joined to their pieces once, and cut between words; what lies
    between two words goes with the first of them.
    """
    sizes, _, taken = _prepared(docs, mix)
    parts = _meet(taken, pieces(packed(sizes, mix), mix)).groupBy(
        "c.doc_id", "c.text_hash", "c.source", "c.start", "c.size", "t.epoch"
    ).agg(
        F.sort_array(F.collect_list(F.struct("first", "words"))).alias("parts"), F.sum("words").alias("_taken")
    )
    p = parts.select("doc_id", "text_hash", "source", "parts", (F.col("_taken") == F.col("size")).alias("whole")).alias("p")
    rows, old = numbered(docs)
    rows = rows.select("*", F.xxhash64(old["text"]).alias("_h"), old["doc_id"].alias("_id"), old["source"].alias("_s"))
    equal_rows = sizes.where("size > 0").groupBy("doc_id", "text_hash", "source").count().where("count > 1")
    if not equal_rows.isEmpty():
        # Each of them has its own places in the stream; the text is needed once.
        rows = rows.dropDuplicates(["_id", "_s", "_h"])
    same = (
        (F.col("_h") == F.col("p.text_hash"))
        & F.col("_id").eqNullSafe(F.col("p.doc_id"))
        & F.col("_s").eqNullSafe(F.col("p.source"))
    )
    met = rows.join(p, same)
    cut = computed(met, _words=F.when(F.col("whole"), F.array().cast("array<string>")).otherwise(tokens(old["text"])))
    taken_words = F.flatten(
        F.transform("parts", lambda x: F.slice("_words", (x["first"] + 1).cast("int"), x["words"].cast("int")))
    )
    made = computed(cut, _text=F.when(F.col("whole"), old["text"]).otherwise(F.array_join(taken_words, "")))
    return restored(made, docs, F.col("_text"))


def tokens(text: Column) -> Column:
    """Words with the white space after them; white space before the first stays with it."""
    return F.regexp_extract_all(text, F.lit(rf"(?:^[\x20\x09-\x0D]+)?{WORD}[\x20\x09-\x0D]*"), F.lit(0))


def _meet(taken: DataFrame, cut: DataFrame) -> DataFrame:
    t, c = taken.alias("t"), cut.alias("c")
    return c.join(t, F.col("t.source").eqNullSafe(F.col("c.source")) & (F.col("t.block") == F.col("c.block")))


def words_taken(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per row of ``docs``: ``doc_id, size, source_size, target, taken``."""
    rows, targets, taken = _prepared(docs, mix)
    times = taken.groupBy("source", "block").agg(F.count("*").alias("times"))
    cut = pieces(packed(rows, mix), mix)
    t, c = times.alias("t"), cut.alias("c")
    used = c.join(
        t, F.col("t.source").eqNullSafe(F.col("c.source")) & (F.col("t.block") == F.col("c.block")), "left"
    ).groupBy("c.doc_id", "c.source", "c.size", "c.start").agg(
        F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken")
    ).select("doc_id", "source", "size", "taken")
    idle = rows.where("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken"))
    u, g = used.unionByName(idle).alias("u"), targets.alias("g")
    return u.join(g, F.col("u.source").eqNullSafe(F.col("g.source"))).select(
        "u.doc_id", "u.size", "g.source_size", "g.target", "u.taken"
    )
