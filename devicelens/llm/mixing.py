"""Mixing sources to target weights with DataFrame functions only.

The words of each source, document after document, are packed into blocks of fixed length. Output shards draw
how many of their slots each source fills (multinomial draws, settled so that a source's slots add up to its
target). The slots of a source are numbered over all shards; a pseudorandom permutation of the source's block
numbers maps slot to block, a new one for each pass over the source, and a join on (source, block) fetches
what the slots take.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from devicelens.operators.ordered import count_at_or_below
from devicelens.session import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block, slots of an output shard, passes over a source at most, rounds of the permutation.
BLOCK, SHARD_SLOTS, PASSES, ROUNDS = 64, 4_096, 3, 12
#: Documents of a source that are numbered together.
CHUNK = 20_000
#: Shards whose slots are counted together, and slots that a task makes.
RUN, TASK_SLOTS = 1_024, 250_000


def n_words(text: Column) -> Column:
    """Runs of characters other than space and tab to carriage return."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), passes: int = PASSES) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``): shares of the total by weight, none above ``passes`` times its size.

    Sources by code point, null last, take the weights in turn. Filling to a common level per unit of weight has
    a closed form: with sources in the order of (limit per weight), those up to some place get their limit, and the
    rest share what is left by weight. One row per source goes through one task here, not the documents.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights)) + 1)
    rows = sizes.withColumn("w", weight).withColumn("most", F.col("source_size") * float(passes))
    every = W.partitionBy()
    filled = W.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("total", F.sum("source_size").over(every).cast("double")).withColumn("weights", F.sum("w").over(every))
    level = (F.col("total") - F.coalesce(F.sum("most").over(filled), F.lit(0.0))) / (F.col("weights") - F.coalesce(F.sum("w").over(filled), F.lit(0.0)))
    rows = rows.withColumn("level", level)
    # The first source that its level does not fill sets the level of all after it.
    stop = F.min(F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct((F.col("most") / F.col("w")).alias("r"), F.col("level").alias("level")))).over(every)
    share = F.col("w") * F.coalesce(stop["level"], F.lit(float("inf")))
    return rows.withColumn("target", F.least(share, F.col("most"))).select("source", "source_size", "w", "target")


def _uniform(*columns: Column | str) -> Column:
    """A number in [0, 1) from the hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / float(1 << 40)


def permuted(number: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 to n - 1, chosen by the key: rounds of "swap or not".

    Each round pairs every number with its mirror about a round key, and the hash of the pair says whether both swap;
    that is a permutation for any n.
    """

    def round_(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        swap = F.xxhash64(*key, r, F.greatest(x, mirror)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), number, round_)


def slots(blocks: DataFrame, seed: int) -> DataFrame:
    """``source``, ``shard``, ``pass``, ``block`` of every output slot; ``blocks`` has ``source``, ``n_blocks``, ``n_slots`` per source.

    Slots are drawn shard by shard with a uniform number each against the cumulated shares. Where the draws of a source
    exceed its slots, its last ones are dropped; where they fall short, slots are added to the shards in turn. The shares
    are a table with one row per source, joined by range to the slots: a few rows, held by each task.
    """
    spark = blocks.sparkSession
    order = W.orderBy(F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    shares = blocks.where("n_slots > 0").withColumn("upto", F.sum("n_slots").over(order)).withColumn("from", F.col("upto") - F.col("n_slots"))
    shares = cut(shares)
    total, sources = shares.agg(F.sum("n_slots"), F.count("*")).first()
    total = total or 0
    # The cumulated shares and their sources, as long as there are sources, not documents; each slot searches them by halves.
    bounds = shares.agg(F.sort_array(F.collect_list(F.struct("upto", "source"))).alias("bounds"))
    drawn = spark.range(total).withColumn("shard", F.floor(F.col("id") / SHARD_SLOTS).cast("long"))
    drawn = drawn.withColumn("u", F.floor(_uniform(F.lit(seed), F.col("id")) * total).cast("long"))
    drawn = drawn.withColumns({"upto": bounds.select("bounds.upto").scalar(), "sources": bounds.select("bounds.source").scalar()})
    drawn = count_at_or_below(drawn, "upto", F.col("u"), sources, "hit")
    counts = drawn.groupBy(F.get("sources", F.col("hit")).alias("source"), "shard").agg(F.count("*").alias("n"))
    counts = cut(counts)
    known = shares.select(F.col("source").alias("s"), "n_blocks", "n_slots")
    # How many slots of the source the shards before have: by runs of shards, then within them.
    counts = counts.withColumn("run", F.floor(F.col("shard") / RUN).cast("long"))
    runs = counts.groupBy("source", "run").agg(F.sum("n").alias("all"))
    earlier = W.partitionBy("source").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select(F.col("source").alias("s"), F.col("run").alias("r"), F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base"))
    inside = W.partitionBy("source", "run").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    counts = counts.join(runs, F.col("source").eqNullSafe(F.col("s")) & (F.col("run") == F.col("r"))).withColumn("before", F.col("before") + F.col("base")).drop("s", "r", "base", "run")
    settled = counts.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    settled = settled.withColumn("n", F.greatest(F.lit(0), F.least("n", F.col("n_slots") - F.col("before"))))
    # A row here is a few numbers and becomes thousands of slots: rows are dealt over all cores first, a source's shards too.
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_SLOTS))
    settled = settled.where("n > 0").select("source", "n_blocks", "shard", "before", "n").repartition(tasks, "source", "shard")
    numbered = settled.select("source", "n_blocks", "shard", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("slot"))
    have = counts.groupBy("source").agg(F.sum("n").alias("have"))
    short = known.join(have, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < n_slots")
    shards = max(1, -(-total // SHARD_SLOTS))
    added = short.select(F.col("s").alias("source"), "n_blocks", F.explode(F.sequence(F.col("have"), F.col("n_slots") - 1)).alias("slot"))
    added = added.select("source", "n_blocks", F.pmod(F.col("slot"), F.lit(shards)).alias("shard"), "slot")
    every = numbered.unionByName(added)
    walk = F.floor(F.col("slot") / F.col("n_blocks")).cast("long")
    block = permuted(F.pmod(F.col("slot"), F.col("n_blocks")), F.col("n_blocks"), F.lit(seed), F.coalesce("source", F.lit("")), F.col("source").isNull(), walk)
    return every.select("source", "shard", walk.alias("pass"), block.alias("block"))


def row_key(ident: Column | str, source: Column | str, text: Column | str) -> Column:
    """SHA-256 of the three values, as bytes; null differs from the empty text."""
    value = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    part = lambda c: F.coalesce(F.concat(F.length(value(c)).cast("string"), F.lit(":"), value(c)), F.lit("-"))
    return F.unhex(F.sha2(F.concat(part(ident), part(source), part(text)).cast("binary"), 256))


def pieces(docs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Rows (``id``, ``source``, ``text``) as ``rows`` with a key, and their ``pieces`` of blocks.

    ``rows``: ``key``, ``id``, ``source``, ``size``, ``copies``; rows equal in all three columns are one with so many copies.
    ``pieces``: ``key``, ``source``, ``block``, ``start``, ``words``: ``words`` words of the row from word ``start`` on lie in that
    block of its source. Rows are numbered within chunks of a source dealt by hash of the key, and chunks one after the other,
    so a source of any size is packed in parts.
    """
    narrow = docs.select(row_key("id", "source", "text").alias("key"), "id", "source", n_words(F.col("text")).alias("size"))
    rows = cut(narrow.groupBy("key", "id", "source", "size").agg(F.count("*").alias("copies")))
    parts = max(1, -(-rows.count() // CHUNK))
    placed = rows.withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(parts))).withColumn("span", F.col("size") * F.col("copies"))
    chunks = placed.groupBy("source", "chunk").agg(F.sum("span").alias("n"))
    before = W.partitionBy("source").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = chunks.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = W.partitionBy("source", "chunk").orderBy(F.col("id").asc_nulls_last(), "key").rowsBetween(W.unboundedPreceding, 0)
    placed = placed.withColumn("upto", F.sum("span").over(inside))
    known = chunks.select(F.col("source").alias("s"), F.col("chunk").alias("c"), "base")
    placed = placed.join(known, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c"))).where("span > 0")
    placed = placed.withColumn("from", F.col("base") + F.col("upto") - F.col("span"))
    cover = F.explode(F.sequence(F.floor(F.col("from") / block).cast("long"), F.floor((F.col("from") + F.col("span") - 1) / block).cast("long")))
    found = placed.select("key", "source", "span", "from", cover.alias("block"))
    start = F.greatest(F.lit(0), F.col("block") * block - F.col("from"))
    end = F.least(F.col("span"), (F.col("block") + 1) * block - F.col("from"))
    return rows, found.select("key", "source", "block", start.alias("start"), (end - start).alias("words"))


def plan(docs: DataFrame, seed: int = 7, block: int = BLOCK, weights: tuple[int, ...] = (1, 2, 3)) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows, pieces, targets and slots for documents with ``id``, ``source``, ``text``."""
    rows, found = pieces(docs, block)
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    aimed = cut(targets(sizes, weights))
    n_blocks = F.ceil(F.col("source_size") / block).cast("long")
    # Slots follow the target in blocks as the source's words lie in them: three times the size is three times each block.
    n_slots = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * n_blocks)).otherwise(0).cast("long")
    return rows, found, aimed, slots(aimed.select("source", n_blocks.alias("n_blocks"), n_slots.alias("n_slots")), seed)


def _met(found: DataFrame, slot: DataFrame) -> DataFrame:
    """Pieces with what the slots say of their block."""
    named = slot.withColumnsRenamed({"source": "s", "block": "b"})
    return found.join(named, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))


def mixed(docs: DataFrame, seed: int = 7, block: int = BLOCK, weights: tuple[int, ...] = (1, 2, 3), id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The id, ``size``, ``source_size``, ``target`` and ``taken`` of every row: how many of its words the mix takes, repeats counted.

    A null or empty text has size 0 and is never taken. Null is a source of its own, the last. Rows repeated in id, source
    and text are given back as often, each taken as often as their mean, rounded down. An empty table gives no rows.
    Only the three named columns are read. The result depends on the rows and the seed alone, not on how they lie.
    """
    named = docs.select(F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"), F.col(text_column).cast("string").alias("text"))
    rows, found, aimed, every = plan(named, seed, block, weights)
    times = every.groupBy("source", "block").agg(F.count("*").alias("times"))
    taken = _met(found, times).groupBy("key").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    each = rows.join(taken, "key", "left").withColumn("taken", F.floor(F.coalesce("taken", F.lit(0)) / F.col("copies")).cast("long"))
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    goal = aimed.select(F.col("source").alias("s"), "source_size", "target")
    joined = each.join(goal, F.col("source").eqNullSafe(F.col("s")))
    return joined.select(F.col("id").alias(id_column), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, seed: int = 7, block: int = BLOCK, weights: tuple[int, ...] = (1, 2, 3), id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per document and pass, its text the words which that pass takes.

    A document that a pass takes whole keeps its text as it is; of others the words taken follow each other with one
    space. ``n_chars``, if there, is counted anew. Documents that no slot takes are left out; repeated rows are one row.
    """
    key = row_key(F.col(id_column), F.col(source_column).cast("string"), F.col(text_column).cast("string"))
    named = docs.select(F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"), F.col(text_column).cast("string").alias("text"))
    rows, found, _, every = plan(named, seed, block, weights)
    span = F.array_sort(F.collect_list(F.struct("start", "words")))
    per_pass = _met(found, every).groupBy("key", "pass").agg(span.alias("spans"), F.sum("words").alias("n"))
    per_pass = per_pass.select(F.col("key").alias("_key"), F.struct("spans", "n").alias("_taken"))
    packed = docs.select(key.alias("_key"), F.struct("*").alias("_row")).dropDuplicates(["_key"])
    joined = packed.join(per_pass, "_key")
    words = F.regexp_extract_all(F.col("_row")[text_column], F.lit(WORD), F.lit(0))
    joined = joined.withColumn("_words", words)
    index = lambda p: F.transform(F.sequence(p["start"], p["start"] + p["words"] - 1), lambda i: F.get(F.col("_words"), F.pmod(i, F.size("_words").cast("long")).cast("int")))
    part = F.array_join(F.flatten(F.transform(F.col("_taken.spans"), index)), " ")
    text = F.when(F.col("_taken.n") == F.size("_words"), F.col("_row")[text_column]).otherwise(part)
    joined = joined.withColumn("_text", text)
    out = []
    for field in docs.schema.fields:
        value = F.col("_row")[field.name]
        if field.name == text_column:
            value = F.col("_text")
        elif field.name == "n_chars":
            value = F.length("_text").cast(field.dataType)
        out.append(value.alias(field.name))
    return joined.select(*out)
