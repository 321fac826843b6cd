"""Spelling variants: words one edit apart, each grouped under a more frequent form.

Words are counted over all texts; all else works on the distinct words. Pairs one edit apart are found
by asymmetric q-chunks: the longer word of a pair (of two equally long ones the smaller) gives two
disjoint chunks, its halves; the other gives its positional grams. One edit touches one half, so the
other half is a gram of the other word, at the same place if it lies before the edit, shifted by the
difference of the lengths (none or one) if behind it. Grams at other places could not be met by a
single edit and are not made. Chunks and grams meet by hash and are then verified.

**Groups that share a half** can be large: thousands of words begin alike. Where chunks times grams of
a key exceed ``KEY_PAIRS``, the touched half is halved again: one of its two parts is untouched and joins the
key. The hole that a key leaves open shrinks so to one character, where all that meet are within one
edit and no more than the alphabet has letters. So what meets is bounded by the near pairs there are, no
pairs of a large group are made, and no cap drops any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import ascii_lower, column, text_of
from txlake.operators.skew import broadcast_if_small
from txlake.session import stage

#: Letters after A-Z are lower-cased.
RUN = r"([a-zÀ-ÿ]+)"
KEY_PAIRS = 2_000


def observed_words(docs: DataFrame, id_col: str, text_col: str, drop_every: int | None) -> DataFrame:
    """One row (word) per run of letters. With ``drop_every``, runs whose draw it divides lose a letter."""
    runs = docs.select(
        F.coalesce(column(docs, id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(ascii_lower(text_of(column(docs, text_col))), F.lit(RUN), F.lit(1))).alias("run"),
    )
    if drop_every is None:
        return runs.select(F.col("run").alias("word"))
    drawn = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("draw"))
    at = (F.col("draw") % F.length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return drawn.select(F.when(F.col("draw") % drop_every == 0, shorter).otherwise(F.col("run")).alias("word"))


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, length, begin, end) with the hash of what surrounds the hole of a word as long as
    ``length``, seen from a word that may be one shorter."""
    before = F.substr("word", F.lit(1), F.col("begin"))
    behind = F.substr("word", F.col("end") + 1 - F.col("length") + F.length("word"))
    return rows.withColumn("key", F.xxhash64("length", "begin", "end", before, behind))


def _holes(length: Column) -> Column:
    """The two halves of a word of a length, each being the hole that the other one leaves."""
    half = F.floor(length / 2).cast("int")
    return F.array(
        F.struct(length.alias("length"), half.alias("begin"), length.alias("end")),
        F.struct(length.alias("length"), F.lit(0).alias("begin"), half.alias("end")),
    )


def _sides(words: DataFrame) -> DataFrame:
    """Chunk rows of every word, and its gram rows for partners as long or one longer."""
    size = F.length("word")

    def rows(holes: Column, is_gram: bool) -> DataFrame:
        made = words.select("word", "n", F.explode(holes).alias("hole")).select("word", "n", "hole.*")
        return _keyed(made).withColumn("gram", F.lit(is_gram))

    return rows(_holes(size), False).unionByName(rows(F.concat(_holes(size), _holes(size + 1)), True))


def _halved(rows: DataFrame) -> DataFrame:
    """Each hole as its two halves."""
    middle = F.floor((F.col("begin") + F.col("end")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("begin"), middle.alias("end")), F.struct(middle.alias("begin"), F.col("end")),
    )
    parts = rows.select("word", "n", "length", "gram", F.explode(halves).alias("hole"))
    return _keyed(parts.select("word", "n", "length", "gram", "hole.*"))


def _meet(rows: DataFrame) -> DataFrame:
    """Verified pairs (word, n, near, near_n) of chunks and grams with equal keys, each pair once."""
    chunks = rows.where(~F.col("gram")).select("key", "word", "n", "begin")
    grams = rows.where("gram").select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = chunks.join(grams, "key")
    same_length = F.length("word") == F.length("near")
    # Where a letter is doubled, several of its places can be left out: the leftmost hole counts.
    earlier = F.concat(F.substr("word", F.lit(1), F.col("begin") - 1), F.substr("word", F.col("begin") + 1))
    once = F.when(same_length, F.col("word") < F.col("near")).otherwise((F.col("begin") == 0) | (earlier != F.col("near")))
    return met.where(once & (F.levenshtein("word", "near", 1) == 1)).select("word", "n", "near", "near_n")


def near_pairs(words: DataFrame, key_pairs: int = KEY_PAIRS) -> DataFrame:
    """Pairs (word, n, near, near_n) of rows (word, n) with distinct words that are one inserted, deleted or
    replaced character apart, each once."""
    rows, found = stage(_sides(words), "spelling-sides"), None
    while True:
        crowded = (
            rows.where("end - begin > 1").groupBy("key")
            .agg(F.count_if(~F.col("gram")).alias("chunks"), F.count_if("gram").alias("grams"))
            .where(F.col("chunks") * F.col("grams") > key_pairs).select("key")
        )
        crowded = broadcast_if_small(crowded)
        done = not crowded.take(1)
        pairs = _meet(rows if done else rows.join(crowded, "key", "left_anti"))
        found = pairs if found is None else found.unionByName(pairs)
        if done:
            return found
        rows = stage(_halved(rows.join(crowded, "key", "left_semi")), "spelling-sides")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): forms followed to the last, twice as far each round.

    A form is at least twice as frequent as its word, so no chain is longer than the binary digits of
    the largest count.
    """
    reached = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = reached.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        step = stage(step, "spelling-roots")
        reached = step.select("word", "root")
        if not step.where("moved").take(1):
            return reached


def variant_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, min_count: int = 3,
    ratio: int = 2, drop_every: int | None = None, key_pairs: int = KEY_PAIRS,
) -> DataFrame:
    """One row per word: ``word``, ``n`` (occurrences), ``n_near`` (words one edit apart), ``form`` (the most
    frequent of these, ties to the smallest in code-point order, if it occurs at least ``ratio`` times as
    often, else null), ``form_n`` and ``root`` (``form`` of ``form`` and so on to the last; the word itself
    if it has none). ``ratio`` must be above 1.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of at least ``min_chars`` code points
    that occur ``min_count`` times or more in all texts together. ``drop_every`` takes a letter out of
    some occurrences, drawn by id and run; by default none. Null and empty texts have no words; a
    null id is drawn as an empty one; repeated rows count each. A very long text is cut into its words by
    one task, in linear time; a very long word has six keys like any other. Only id and text are read, so
    other columns may have any name. An empty table gives an empty one.
    """
    if ratio < 2:
        raise ValueError("with a ratio below 2 forms could go round in circles")
    words = stage(
        observed_words(docs, id_col, text_col, drop_every).where(F.length("word") >= min_chars)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count),
        "spelling-words",
    )
    pairs = near_pairs(words, key_pairs)
    both = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    best = F.min(F.struct((-F.col("near_n")).alias("rarity"), F.col("near").alias("near")))
    known = stage(
        pairs.select(F.explode(both).alias("p")).select("p.*")
        .groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")),
        "spelling-near",
    )
    frequent = -F.col("best.rarity") >= ratio * F.col("n")
    formed = known.select(
        "word", "n_near", F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.rarity")).alias("form_n")
    )
    roots = _roots(formed.where("form IS NOT NULL"))
    return (
        words.join(formed, "word", "left").join(roots, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n",
        )
    )
