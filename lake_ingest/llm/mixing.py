"""Mixing sources to target weights: highest-quotient apportionment of equal-token blocks.

The words of a source, its documents in a seeded order, are a ring of equal blocks. Blocks are given
to the sources one at a time, always to the source with the highest quotient target / (2 * seats + 1);
the first shard holds the first blocks given, and so on, so a shard's quotas are whole numbers and
every prefix of the shards is itself mixed to the targets. A source then takes its blocks from the
start of its ring, going round again where its quota exceeds it.

Nothing is enumerated per block: the seats that are certain are counted in closed form, and only
about two seats per source and shard are ranked. Documents are touched once to be measured, and once
to be joined with the position where their range of the ring starts; sums are taken per source and
hash range first, so that no source is ever gathered in one task.

Defined results: a null text has size 0; a null source is a source of its own, the last; documents of
size 0 take nothing; of repeated rows each has its own place in the ring; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lake_ingest.functions.keys import quoted
from lake_ingest.llm.shared import SPACE, WORD, saved, words

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
BLOCKS_PER_SOURCE = 100
MAX_BLOCK_TOKENS = 2048
SHARD_TOKENS = 1 << 28
# Hexadecimal digits of the order that name a hash range: 4,096 ranges per source.
RANGE_DIGITS = 3


def source_key(source: str) -> Column:
    """Text that orders as the source does by code point, with null as a last value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("~"))


def seeded_order(doc_id: str, text: str, seed: int = SEED) -> Column:
    """Place of a document in its source's ring: the same only for the same document and text."""
    return F.md5(
        F.concat_ws(
            ":",
            F.lit(str(seed)),
            F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
            F.md5(F.coalesce(F.col(text), F.lit(""))),
        )
    )


def sizes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED
) -> DataFrame:
    """One row ``(doc_id, _source, size, _order)`` per document, ``_order`` its seeded place."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        source_key(source).alias("_source"),
        F.size(words(text)).cast("long").alias("size"),
        seeded_order(doc_id, text, seed).alias("_order"),
    )


def targets(measured: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source ``(_source, source_size, weight, target)``.

    All sizes together are shared by weight. A source stops at ``epochs`` times its size, and what it
    cannot take goes to the others by weight: with the sources ordered by cap / weight, the level is
    that of the first source whose cap is not reached. One row per source goes through one task.
    """
    everything = Window.partitionBy(F.lit(0))
    numbered = (
        measured.groupBy("_source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_place", F.row_number().over(everything.orderBy("_source")) - 1)
    )
    weight = F.element_at(
        F.array(*(F.lit(w) for w in weights)), (F.col("_place") % len(weights) + 1).cast("int")
    )
    capped = numbered.withColumn("weight", weight.cast("long")).withColumn(
        "_cap", F.col("source_size") * epochs
    )
    by_level = everything.orderBy(F.col("_cap") / F.col("weight"), "_source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    levels = capped.withColumns(
        {
            "_left": F.sum("source_size").over(everything)
            - F.coalesce(F.sum("_cap").over(before), F.lit(0)),
            "_weights": F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "_rank": F.row_number().over(by_level),
        }
    )
    reached = F.col("_left") * F.col("weight") <= F.col("_cap") * F.col("_weights")
    level = F.min_by(
        F.when(reached, F.col("_left") / F.col("_weights")), F.when(reached, F.col("_rank"))
    ).over(everything)
    return levels.withColumn("target", F.least(F.col("_cap").cast("double"), level * F.col("weight"))).select(
        "_source", "source_size", "weight", "target"
    )


def shard_quotas(
    sources: DataFrame, block_tokens: int | None = None, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Per source and shard ``(_source, shard, quota, seats)``: blocks of this shard, and of all up to it.

    ``block_tokens`` defaults to a hundredth of the smallest target, at most 2,048, so that rounding to
    blocks moves no source by more than about a hundredth.
    """
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(everything)
    block = (
        F.lit(block_tokens)
        if block_tokens
        else F.greatest(
            F.lit(1),
            F.least(
                F.lit(MAX_BLOCK_TOKENS),
                F.floor(
                    F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything)
                    / BLOCKS_PER_SOURCE
                ),
            ),
        )
    )
    shards = F.greatest(F.lit(1), F.ceil(total / shard_tokens))
    houses = (
        sources.where("source_size > 0")
        .withColumns(
            {
                "block_tokens": block.cast("long"),
                "_total": total,
                "_votes": F.sum("target").over(everything),
                "_slack": F.count("*").over(everything) / 2 + 1,
                "_shards": shards.cast("long"),
            }
        )
        .withColumn("shard", F.explode(F.expr("sequence(0L, _shards - 1)")))
        .withColumn("_house", F.expr("CAST(round(_total / block_tokens) AS bigint) * (shard + 1) DIV _shards"))
        .withColumns(
            {
                "_sure": F.expr(
                    "CAST(greatest(0, floor(target * greatest(0, _house - _slack) / _votes + 0.5)) AS bigint)"
                ),
                "_most": F.expr("CAST(floor(target * (_house + _slack) / _votes + 0.5) AS bigint)"),
            }
        )
    )
    per_shard = Window.partitionBy("shard")
    contest = (
        houses.withColumn("_open", F.col("_house") - F.sum("_sure").over(per_shard))
        .withColumn("_seat", F.explode(F.expr("sequence(_sure, greatest(_sure, _most))")))
        .withColumn(
            "_rank",
            F.row_number().over(
                per_shard.orderBy((F.col("target") / (2 * F.col("_seat") + 1)).desc(), "_source")
            ),
        )
    )
    seats = contest.groupBy("_source", "shard", "source_size", "target", "block_tokens").agg(
        (F.first("_sure") + F.count(F.when(F.col("_rank") <= F.col("_open"), 1))).alias("seats")
    )
    earlier = F.lag("seats", 1, 0).over(Window.partitionBy("_source").orderBy("shard"))
    return seats.withColumn("quota", F.col("seats") - earlier)


def taken_per_source(quotas: DataFrame, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source ``(_source, _taken)``: the words in its blocks, rounds over the whole ring included."""
    blocks = "greatest(1L, CAST(round(source_size / block_tokens) AS bigint))"
    return (
        quotas.groupBy("_source", "source_size", "block_tokens")
        .agg(F.max("seats").alias("_seats"))
        .withColumn("_blocks", F.expr(blocks))
        .selectExpr(
            "_source",
            f"""least({epochs} * source_size, (_seats DIV _blocks) * source_size
                + CAST(floor((_seats % _blocks) * source_size / _blocks) AS bigint)) AS _taken""",
        )
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    block_tokens: int | None = None,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Per document ``(doc_id, size, source_size, target, taken, rounds, first_words)``.

    ``taken`` is ``rounds`` times the whole document and its first ``first_words`` words once more.
    """
    return place(
        docs, doc_id, text, source, weights=weights, epochs=epochs, seed=seed,
        block_tokens=block_tokens, shard_tokens=shard_tokens,
    ).drop("_source", "_order")


def place(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    block_tokens: int | None = None,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """As ``mix``, with ``_source`` and ``_order``, which tell different documents apart."""
    measured = saved(sizes(docs, doc_id, text, source, seed), "sizes").withColumn(
        "_range", F.substring("_order", 1, RANGE_DIGITS)
    )
    sources = saved(targets(measured, weights, epochs), "targets")
    taken = taken_per_source(shard_quotas(sources, block_tokens, shard_tokens), epochs)
    ranges = measured.groupBy("_source", "_range").agg(F.sum("size").alias("_words"))
    up_to = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.withColumn("_start", F.coalesce(F.sum("_words").over(up_to), F.lit(0)))
        .join(sources, "_source")
        .join(taken, "_source", "left")
        .select("_source", "_range", "_start", "source_size", "target", F.coalesce("_taken", F.lit(0)).alias("_taken"))
    )
    in_range = (
        Window.partitionBy("_source", "_range")
        .orderBy("_order", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        measured.withColumn("_ahead", F.coalesce(F.sum("size").over(in_range), F.lit(0)))
        .join(starts, ["_source", "_range"])
        .withColumn("_start", F.col("_start") + F.col("_ahead"))
    )
    return (
        placed.withColumn("rounds", F.expr("if(source_size = 0, 0L, _taken DIV source_size)"))
        .withColumn(
            "first_words",
            F.expr("if(source_size = 0, 0L, greatest(0L, least(size, _taken % source_size - _start)))"),
        )
        .withColumn("taken", F.expr("rounds * size + first_words"))
        .select("_source", "_order", "doc_id", "size", "source_size", "target", "taken", "rounds", "first_words")
    )


def mixed_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The rows of ``docs`` that the mix is made of: each as often as it is taken, the last time cut to its first words.

    The columns are those of ``docs``. Rows equal in document, text and source share what they take.
    """
    seed = options.get("seed", SEED)
    plan = (
        place(docs, doc_id, text, source, **options)
        .groupBy("_source", "_order")
        .agg(
            F.sum(F.col("rounds") + F.expr("if(size > 0 AND first_words = size, 1, 0)")).alias("_whole"),
            F.sum(F.expr("if(first_words < size, first_words, 0)")).alias("_part"),
            F.count("*").alias("_rows"),
        )
        .where("_whole > 0 OR _part > 0")
    )
    columns = [F.col(f"_doc.{quoted(c)}").alias(c) for c in docs.columns]
    keyed = docs.select(
        F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("_doc"),
        source_key(source).alias("_source"),
        seeded_order(doc_id, text, seed).alias("_order"),
    )
    nth = F.row_number().over(Window.partitionBy("_source", "_order").orderBy(F.lit(0)))
    copies = F.expr(
        """concat(
            array_repeat(CAST(NULL AS bigint),
                CAST(_whole DIV _rows + if(_nth <= _whole % _rows, 1, 0) AS int)),
            if(_nth = _rows AND _part > 0, array(_part), array()))"""
    )
    cut = F.array_join(
        F.slice(F.regexp_extract_all(F.col("_text"), F.lit(f"(?:{SPACE})?{WORD}"), F.lit(0)), 1, F.col("_words").cast("int")), ""
    )
    taken = (
        keyed.join(plan, ["_source", "_order"])
        .withColumn("_nth", nth)
        .withColumn("_words", F.explode(copies))
        .withColumn("_text", F.col(f"_doc.{quoted(text)}"))
        .withColumn("_text", F.when(F.col("_words").isNull(), F.col("_text")).otherwise(cut))
    )
    return taken.select(
        *(F.col("_text").alias(c) if c == text else column for c, column in zip(docs.columns, columns))
    )
