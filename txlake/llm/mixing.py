"""Mix sources to target weights along a low-discrepancy schedule.

Slots of the mix are numbered; slot n has the golden-ratio point frac(n / phi), kept exact in integers.
The points are mapped through the cumulative weights of the sources, so that every stretch of the mix
holds the sources in nearly their weights, and the slots of a source are ranked. The documents of a
source are shuffled by hash and laid end to end, once per epoch, and the line is cut into blocks of
equal numbers of words; slot and block meet on (source, rank).

No step orders all documents of a source in one task: positions are sums within 4096 hash buckets plus
the buckets before, ranks are counts within stretches of slots plus the stretches before. Slots and
block pieces join on (source, rank), which spreads a hot source over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.common import column, fresh, words
from txlake.operators.ordering import running_totals, sequential_ids
from txlake.session import stage

# The golden-ratio lattice: multiples of an odd step near 2^31 / phi, modulo 2^31.
PERIOD = 1 << 31
STEP = 1327217885
WEIGHTS = (5.0, 2.0, 1.0)
STRETCH = 1 << 16
SEED = 20
_BEFORE = (Window.unboundedPreceding, -1)


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document with its size in words; equal rows are told apart by ``copy``.

    Rows are told apart by id, source and text, so a null or repeated id does no harm.
    """
    text = column(docs, text_col)
    sized = docs.select(
        column(docs, id_col).alias("id"), column(docs, source_col).cast("string").alias("source"),
        F.size(words(text)).cast("long").alias("size"), F.xxhash64(text).alias("version"),
    )
    counted = sized.groupBy("id", "source", "size", "version").agg(F.count(F.lit(1)).alias("copies"))
    return stage(counted.select("id", "source", "size", "version", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")), "mix-units")


def targets(units_: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source: ``source_size``, ``weight``, ``target`` and the whole words to take, ``goal``.

    Sources in code-point order, null last, get the weights in turn and share ``share`` of all sizes.
    A target stops at ``most`` times its source's size; what is over goes to the others by weight
    until none is above. That is one water level: targets are min(cap, level * weight), and the level
    follows from running totals of caps and weights in the order of cap / weight.
    """
    sizes = units_.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sequential_ids(sizes.withColumn("absent", F.col("source").isNull()), ["absent", "source"], "nth")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    caps = ranked.withColumn("weight", w).withColumn("cap", most * F.col("source_size"))
    caps = caps.withColumn("ratio", F.col("cap") / F.col("weight"))
    total = caps.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    words_all, weight_all = share * (total["size"] or 0), total["weight"] or 0.0
    level = (
        running_totals(caps, [], ["ratio", "nth"], {"cap": F.col("cap"), "weight": F.col("weight")})
        .select("ratio", "nth", ((F.lit(words_all) - F.col("cap_before")) / (F.lit(weight_all) - F.col("weight_before"))).alias("level"))
        .where(F.col("ratio") >= F.col("level"))
        .agg(F.min_by("level", F.struct("ratio", "nth"))).first()[0]
    )
    target = F.col("cap") if level is None else F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    done = caps.withColumn("target", target)
    return stage(
        done.select("source", "nth", "source_size", "weight", "target", F.least(F.round("target"), F.floor("cap")).cast("long").alias("goal")),
        "mix-targets",
    )


def schedule(goals: DataFrame, block_words: int) -> DataFrame:
    """(nth, rank, slot): the slots of each source, as many as its goal has blocks.

    Slots beyond a source's need are empty; the few ranks that the sequence has not reached follow
    after its end, so every source gets exactly its blocks.
    """
    spark = goals.sparkSession
    needs = goals.where(F.col("goal") > 0).select(
        "nth", "goal", F.ceil(F.col("goal") / block_words).cast("long").alias("need")
    )
    sums = needs.agg(F.sum("goal").alias("goal"), F.sum("need").alias("need"), F.count(F.lit(1)).alias("n")).first()
    all_words, n_slots = sums["goal"] or 0, sums["need"] or 0
    cells = max(1024, 2 * sums["n"])
    before = running_totals(needs, [], ["nth"], {"goal": F.col("goal")})
    lo = F.col("goal_before") / F.lit(float(max(1, all_words)))
    hi = (F.col("goal_before") + F.col("goal")) / F.lit(float(max(1, all_words)))
    spans = before.select("nth", lo.alias("lo"), hi.alias("hi"))
    # A point meets only the sources of its cell, so that many sources need no search over all.
    spans = spans.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("lo") * cells).cast("int"), F.floor(F.col("hi") * cells).cast("int")))
    )
    parts = max(1, min(100_000, n_slots // 500_000))
    slots = spark.range(0, n_slots, 1, parts).select(
        F.col("id").alias("slot"), F.floor(F.col("id") / STRETCH).alias("stretch"),
        ((F.col("id") % PERIOD) * STEP % PERIOD / float(PERIOD)).alias("x"),
    )
    slots = slots.withColumn("cell", F.floor(F.col("x") * cells).cast("int"))
    mapped = slots.join(spans, "cell").where((F.col("x") >= F.col("lo")) & (F.col("x") < F.col("hi")))
    inside = Window.partitionBy("stretch", "nth").orderBy("slot")
    mapped = mapped.select("slot", "stretch", "nth", F.row_number().over(inside).alias("r"))
    per = mapped.groupBy("stretch", "nth").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("nth").orderBy("stretch").rowsBetween(*_BEFORE)
    per = per.select("stretch", "nth", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    ranked = mapped.join(per, ["stretch", "nth"]).select("nth", "slot", (F.col("r") - 1 + F.col("earlier")).alias("rank"))
    ranked = stage(ranked.join(needs.select("nth", "need"), "nth").where(F.col("rank") < F.col("need")).select("nth", "rank", "slot"), "mix-slots")
    reached = ranked.groupBy("nth").agg(F.count(F.lit(1)).alias("n"))
    late = (
        needs.join(reached, "nth", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .where(F.col("n") < F.col("need"))
        .select("nth", F.explode(F.sequence(F.col("n"), F.col("need") - 1)).alias("rank"))
    )
    return ranked.unionByName(late.select("nth", "rank", (F.lit(n_slots) + F.col("rank")).alias("slot")))


def pieces(units_: DataFrame, goals: DataFrame, block_words: int, epochs: int = 2) -> DataFrame:
    """(unit, nth, rank, first_word, n): which words of which document fill which block.

    Every epoch shuffles the documents of a source anew. Positions are summed in two steps: within
    the bucket of a document's hash, and over the buckets before.
    """
    key = ["id", "source", "size", "version", "copy"]
    known = goals.select(F.col("source").alias("of"), "nth", "source_size", "goal")
    rows = units_.where(F.col("size") > 0).join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    rows = rows.where(F.col("goal") > F.col("epoch") * F.col("source_size"))
    rows = rows.withColumn("draw", F.xxhash64(F.lit(SEED), "epoch", "id", "version", "copy"))
    rows = rows.withColumn("bucket", F.shiftrightunsigned("draw", 52))
    inside = Window.partitionBy("nth", "epoch", "bucket").orderBy("draw", "id", "version", "copy").rowsBetween(*_BEFORE)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    sums = rows.groupBy("nth", "epoch", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("nth", "epoch").orderBy("bucket").rowsBetween(*_BEFORE)
    sums = sums.select("nth", "epoch", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    rows = rows.join(sums, ["nth", "epoch", "bucket"])
    rows = rows.withColumn("start", F.col("epoch") * F.col("source_size") + F.col("earlier") + F.col("inside"))
    rows = rows.withColumn("end", F.least(F.col("start") + F.col("size"), F.col("goal"))).where(F.col("start") < F.col("end"))
    first = F.floor(F.col("start") / block_words).cast("long")
    last = F.floor((F.col("end") - 1) / block_words).cast("long")
    cut = rows.withColumn("rank", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("start"), F.col("rank") * block_words)
    hi = F.least(F.col("end"), (F.col("rank") + 1) * block_words)
    return cut.select(*key, "nth", "rank", (lo - F.col("start")).alias("first_word"), (hi - lo).alias("n"))


def mix(units_: DataFrame, goals: DataFrame, block_words: int = 128) -> DataFrame:
    """The mix: (slot, nth, id, source, size, version, copy, first_word, n), in the order of
    (slot, nth), then position. Every row is a run of ``n`` words of one document."""
    return schedule(goals, block_words).join(pieces(units_, goals, block_words), ["nth", "rank"])


def taken_words(docs: DataFrame, block_words: int = 128, **cols: str) -> DataFrame:
    """Per document: ``id``, ``source``, ``size``, ``version``, ``source_size``, ``target``, ``taken``.

    ``taken`` counts the words the mix takes, repeats included; it is 2 * ``size`` at most. Texts that
    are null or have no word take no part and get 0. Null sources are one source, the last. Each of
    several equal rows has its own place in the mix. An empty table gives no rows.
    """
    units_ = units(docs, **cols)
    goals = targets(units_)
    key = ["id", "source", "size", "version", "copy"]
    used = mix(units_, goals, block_words).select(*key, "n")
    both = units_.select(*key, F.lit(0).cast("long").alias("n")).unionByName(used)
    per = both.groupBy(*key).agg(F.sum("n").alias("taken"))
    known = goals.select(F.col("source").alias("of"), "source_size", "target")
    return per.join(known, F.col("source").eqNullSafe(F.col("of"))).select(
        "id", "source", "size", "version", "copy", "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame, block_words: int = 128, **cols: str) -> DataFrame:
    """``docs`` as the mix takes them: every document as often as it is taken, rounded up.

    A document that the mix does not reach is left out; one taken more than once whole is repeated.
    All columns stay.
    """
    (copy,) = fresh(docs, "mix_copy")
    id_col, text_col, source_col = cols.get("id_col", "doc_id"), cols.get("text_col", "text"), cols.get("source_col", "source")
    times = (
        taken_words(docs, block_words, **cols)
        .groupBy("id", "source", "version")
        .agg(F.sum(F.ceil(F.col("taken") / F.greatest("size", F.lit(1)))).alias("times"), F.count(F.lit(1)).alias("rows"))
        .select(F.col("id").alias("mix_id"), F.col("source").alias("mix_source"), F.col("version").alias("mix_version"),
                F.ceil(F.col("times") / F.col("rows")).cast("int").alias("mix_times"))
    )
    joined = docs.join(
        times,
        column(docs, id_col).eqNullSafe(times["mix_id"])
        & column(docs, source_col).cast("string").eqNullSafe(times["mix_source"])
        & (F.xxhash64(column(docs, text_col)) == times["mix_version"]),
    )
    return joined.where(times["mix_times"] > 0).select(
        *[column(docs, c) for c in docs.columns], F.explode(F.sequence(F.lit(1), times["mix_times"])).alias(copy)
    ).drop(copy)
