"""Drop lines that other documents hold as well.

The lines are exploded and hashed; distinct documents per hash are counted with partial sums, hashes
over the threshold are joined back to their holders, and each document is put together again from the
positions that stay. Only hashes and positions are shuffled for the counting; the texts move once, to
meet their list of dropped positions. A line that a third of all documents hold is one row after the
partial sums; in the join back to its holders AQE splits it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import SPACE_CHARS, ascii_lower, bind, column, fresh, text_of
from txlake.session import stage


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
    min_documents: int = 2,
) -> DataFrame:
    """``docs`` with ``text_col`` replaced and ``n_lines``, ``n_dropped`` added.

    A line whose key has ``min_chars`` code points or more and is found in ``min_documents`` documents
    or more stays only in the smallest id that holds it, every time it is there. Ids are integers.

    Null and empty texts are one empty line, and an empty text afterwards. Rows that share an id are
    one holder: either both keep a line or both lose it (each different text of an id counts as a
    document). Null ids are one holder that comes after all ids. All other columns and repeated rows
    stay as they are; if ``docs`` has columns named ``n_lines`` or ``n_dropped``, the new ones end in
    an underscore. An empty table gives an empty one. A very long text takes time in proportion to its
    length; its lines and positions are held by one task.
    """
    n_lines, n_dropped, rid, rtext, rhash = fresh(docs, "n_lines", "n_dropped", "ld_id", "ld_text", "ld_hash")
    text = text_of(column(docs, text_col))
    lines = F.split(text, "\n", -1)

    # The hash of the text comes before the lines, or it would be taken once per line.
    cut = docs.select(column(docs, id_col).cast("long").alias("id"), F.xxhash64(text).alias("version"), lines.alias("lines"))
    exploded = cut.select("id", "version", F.posexplode("lines").alias("pos", "line"))
    keyed = exploded.select("id", "version", "pos", line_key(F.col("line")).alias("key"))
    # Two 64-bit hashes: one alone would collide among some 10^10 different lines.
    hashed = keyed.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "id", "version", "pos"
    )
    holders = stage(
        hashed.groupBy("h1", "h2", "id", "version").agg(F.collect_set("pos").alias("positions")), "line-holders"
    )
    # Written, so that the join back has an exchange of its own on either side: AQE can then split the
    # holders of a line that very many documents share, or broadcast a short list.
    heavy = stage(
        holders.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
        .where((F.col("n") >= min_documents) & F.col("first_id").isNotNull())
        .select("h1", "h2", "first_id"),
        "line-heavy",
    )
    dropped = (
        holders.join(heavy, ["h1", "h2"])
        .where(~F.col("id").eqNullSafe(F.col("first_id")))
        .groupBy(F.col("id").alias(rid), F.col("version").alias(rhash))
        .agg(F.flatten(F.collect_list("positions")).alias(rtext))
    )
    marked = docs.join(
        dropped,
        column(docs, id_col).cast("long").eqNullSafe(dropped[rid]) & (F.xxhash64(text) == dropped[rhash]),
        "left",
    )
    positions = F.coalesce(dropped[rtext], F.array().cast("array<int>"))

    def without(all_lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), positions)
        return F.array_join(F.transform(stay, lambda p: F.get(all_lines, p)), "\n")

    # Bound, so that a text is split once and not once per line that stays.
    kept = F.when(F.size(positions) == 0, text).otherwise(bind(lines, without))
    return marked.select(
        *[kept.alias(c) if c == text_col else column(docs, c) for c in docs.columns],
        F.size(lines).cast("long").alias(n_lines), F.size(positions).cast("long").alias(n_dropped),
    )
