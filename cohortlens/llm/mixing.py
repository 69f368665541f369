"""Mix sources to target weights: a random order within each source, cut at the source's exact budget of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import SPACE_CLASS, SPACES, WORD_CLASS, same, stage, words_of

WEIGHTS = (1, 2, 3)  # of the sources in code-point order, repeating
MAX_EPOCHS = 3  # a source is repeated as often at most


def order_key(seed: int = 0) -> Column:
    """A document's random place in its source; rows that repeat a doc_id share one."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def sizes(docs: DataFrame, seed: int = 0) -> DataFrame:
    return docs.select(
        "doc_id",
        "source",
        order_key(seed).alias("key"),
        F.size(words_of(F.col("text"))).cast("bigint").alias("size"),
    )


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: source_size, target (words) and budget (whole words).

    The weights share all words. A source is full at ``max_epochs`` times its size; what it can't take is shared
    again by weight. With sources in the order in which they fill up, the level at which that ends follows from running
    sums. The table has one row per source, as a list of weights has; only it passes through a single window.
    """
    by_code_point = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_code_point) - 1) % len(weights)) + 1
    )
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    filled = fill.rowsBetween(Window.unboundedPreceding, -1)
    left = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("limit").over(filled), F.lit(0))) / F.sum("weight").over(left)
    return (
        rows.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("limit"))
        .select("*", F.sum("source_size").over(everything).alias("total"))
        .select("*", level.alias("level"))
        .select("*", F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level")))
                .over(everything).alias("water"))
        .select(
            "source",
            "source_size",
            F.least(F.col("water") * F.col("weight"), F.col("limit").cast("double")).alias("target"),
        )
        .select("*", F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * max_epochs).alias("budget"))
    )


def cuts(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source with words to take beyond whole epochs: the key at which its order is cut, and the words left there.

    Places are range-sorted by source and key; the sums of the partitions and then, in the partitions that hold a cut,
    the running sums give each place the words before it. A source with a third of all rows spans many partitions.
    """
    places = rows.where("size > 0").groupBy("source", "key").agg(F.sum("size").alias("size"))
    ranged = stage(
        places.repartitionByRange("source", "key").select("*", F.spark_partition_id().alias("part")), "places"
    )
    wanted = sources.where("source_size > 0").select(
        F.col("source").alias("of"), (F.col("budget") % F.col("source_size")).alias("rest")
    )
    parts = ranged.groupBy("source", "part").agg(F.sum("size").alias("size"))  # each source has a run of partitions
    before = F.coalesce(
        F.sum("size").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    cut_parts = (
        parts.select("source", "part", "size", before.alias("before"))
        .join(wanted, same(F.col("source"), F.col("of")))
        .where("before < rest and rest <= before + size")
        .select("of", F.col("part").alias("cut_part"), "before", "rest")
    )
    within = Window.partitionBy("of").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(cut_parts, same(F.col("source"), F.col("of")) & (F.col("part") == F.col("cut_part")))
        .select("of", "key", "size", "rest", (F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))).alias("before"))
        .where("before < rest and rest <= before + size")
        .select(
            F.col("of").alias("cut_source"),
            F.col("key").alias("cut_key"),
            F.col("size").alias("cut_size"),
            (F.col("rest") - F.col("before")).alias("cut_words"),
        )
    )


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: of, source_size, target, epochs and where its order is cut."""
    sources = stage(targets(rows, weights, max_epochs), "sources")
    cut = cuts(rows, sources)
    return stage(
        sources.join(cut, same(F.col("source"), F.col("cut_source")), "left").select(
            F.col("source").alias("of"),
            "source_size",
            "target",
            F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).alias("epochs"),
            "cut_key",
            "cut_size",
            "cut_words",
        ),
        "mix",
    )


def last_words(size: Column, key: Column) -> Column:
    """Words of a document that the mix takes after the whole epochs: all before the cut, a share at it, then none."""
    return (
        F.when(F.col("cut_key").isNull() | (key > F.col("cut_key")), F.lit(0))
        .when(key < F.col("cut_key"), size)
        .otherwise(F.floor(F.col("cut_words") * size / F.col("cut_size")))
    ).cast("bigint")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 0) -> DataFrame:
    """A row for each row of docs: doc_id, size, source_size, target, taken (words, repeats counted).

    A null text has no words; a null source is a source, the last; null ids share one place in the order. A document
    at the cut gives its first words. Rows that repeat a doc_id within a source share what is taken at the cut, each
    rounded down. Only the table of sources meets the documents. No rows give no rows.
    """
    rows = stage(sizes(docs, seed), "sizes")
    mixed = rows.join(plan(rows, weights, max_epochs), same(F.col("source"), F.col("of")))
    taken = F.col("epochs") * F.col("size") + last_words(F.col("size"), F.col("key"))
    return mixed.select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The first n words of a text with the white space before and between them."""
    pieces = F.split(text, f"(?<={SPACE_CLASS})(?={WORD_CLASS})")
    lead = F.when(F.length(F.trim(pieces[0], F.lit(SPACES))) == 0, 1).otherwise(0)
    return F.rtrim(F.array_join(F.slice(pieces, F.lit(1), (n + lead).cast("int")), ""), F.lit(SPACES))


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 0
) -> DataFrame:
    """The documents of the mix, columns as given: a row for each time one is taken, the one at the cut shortened.

    Documents without words are never taken.
    """
    per_source = plan(stage(sizes(docs, seed), "sizes"), weights, max_epochs)
    size = F.size(words_of(F.col("text"))).cast("bigint")
    rows = docs.select(F.struct("*").alias("_row"), F.col("source").alias("_source"), order_key(seed).alias("_key"), size.alias("_size"))
    last = last_words(F.col("_size"), F.col("_key"))
    copies = (
        rows.join(per_source, same(F.col("_source"), F.col("of")))
        .where("_size > 0")
        .select("_row", "_size", F.concat(
            F.array_repeat(F.col("_size"), F.col("epochs").cast("int")),
            F.when(last > 0, F.array(last)).otherwise(F.array().cast("array<bigint>")),
        ).alias("_copies"))
        .select("_row", "_size", F.explode("_copies").alias("_words"))
    )
    text = F.col("_row")["text"]
    shortened = F.when(F.col("_words") < F.col("_size"), first_words(text, F.col("_words"))).otherwise(text)
    return copies.select(*[shortened.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
