"""The thin queries of this subpackage and, where SQL can express them, their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm import ann, byte_bpe, fill_middle, line_dedup, main_text, mixing, pieces, pii, quality, simhash, spelling, token_counts, warc
from txlake.llm.common import bound_batches, table
from txlake.session import staging_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query("""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), many AS (
  SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), m AS (
  SELECT k.*, (many.key IS NOT NULL AND k.doc_id <> many.first_id) AS gone FROM k LEFT JOIN many USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""")
def op1_line_dedup(spark, sf_dir):
    """Lines of at least 10 code points that several documents hold stay in the smallest doc_id."""
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op2_mix_sources(spark, sf_dir):
    """Words that the mix takes of each document, with its source's size and target."""
    used = mixing.taken_words(table(spark, sf_dir, "documents"))
    return used.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
n AS (
  SELECT doc_id, text, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS worded,
         len(list_filter(range(2, len(w) + 1), lambda k: w[k] = w[k - 1])) AS n_stutter,
         length(regexp_replace(text, '\P{{L}}', '', 'g')) AS letters,
         length(regexp_replace(text, '\P{{Lu}}', '', 'g')) AS upper_letters
  FROM d
), p AS (
  SELECT doc_id, unnest(range(1, n_words - 3)) AS i, w FROM n WHERE n_words >= 5
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g FROM p
), twice AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k.k) AS n FROM twice, range(5) AS k(k) GROUP BY doc_id
), s AS (
  SELECT n.doc_id, n_words, word_chars, n_symbols, len(worded) AS n_lines,
         len(worded) - len(list_distinct(worded)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         n_stutter, letters, upper_letters
  FROM n LEFT JOIN covered c USING (doc_id)
), b AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars > 100 * n_words OR 5 * n_stutter > n_words OR (letters >= 20 AND 2 * upper_letters > letters)) AS kept
FROM b""")
def op3_quality_rules(spark, sf_dir):
    """Figures of every text, the base rules and the verdict of the whole cascade."""
    return quality.figures_and_verdict(table(spark, sf_dir, "documents"))


@query()
def op5_sentencepiece(spark, sf_dir):
    """Number and hash of the ids of every text, and the hash of the text they decode to."""
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    bound_batches(spark)
    both = table(spark, sf_dir, "documents").select("doc_id", pieces.round_trip(F.col("text"), model).alias("r"))
    return both.select(
        "doc_id", pieces.n_ids(F.col("r.ids")).alias("n_tokens"), F.sha2("r.ids", 256).alias("ids_sha256"),
        F.sha2("r.text", 256).alias("decoded_sha256"),
    )


@query()
def op6_personal_data(spark, sf_dir):
    """Counts of the base kinds, the hash of their places, and all places."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.col("base_spans")
    return found.select(
        "doc_id", *[pii.count_kind(base, k.name).alias(f"n_{k.name}") for k in pii.BASE],
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"), pii.spans_text(F.col("spans")).alias("spans"),
    )


@query()
def op8_simhash(spark, sf_dir):
    """Fingerprint and smallest reachable doc_id of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query("""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN p.page_id > f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id > f.first_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)""")
def op4_warc(spark, sf_dir):
    """Every page written to an archive and read back; digests are checked while reading."""
    folder = staging_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query()
def op7_token_counts(spark, sf_dir):
    """Tokens of every document, counted between the separators of flat token files."""
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    folder = staging_path(spark, "tokens")
    files, order = token_counts.write_token_files(table(spark, sf_dir, "documents"), folder, model)
    counted = token_counts.count_tokens(files, folder, pieces.end_id(model))
    return order.join(counted, ["file", "ordinal"]).select(F.col("id").alias("doc_id"), "n_tokens")


@query()
def op10_nearest(spark, sf_dir):
    """The 20 nearest of every vector whose id 20 divides, among all others."""
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query()
def op9_main_text(spark, sf_dir):
    """The main text of every page."""
    return main_text.main_text(table(spark, sf_dir, "pages"))


@query()
def op11_byte_bpe(spark, sf_dir):
    """Number and hash of the ids of every text, and the hash of the text they decode to."""
    vocabulary = byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    bound_batches(spark)
    both = table(spark, sf_dir, "documents").select("doc_id", byte_bpe.round_trip(F.col("text"), vocabulary).alias("r"))
    return both.select(
        "doc_id", F.size("r.ids").cast("long").alias("n_tokens"), F.sha2(byte_bpe.decimal_ids(F.col("r.ids")), 256).alias("ids_sha256"),
        F.sha2("r.text", 256).alias("decoded_sha256"),
    )


@query(r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
  FROM documents
), r AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT doc_id, text, n, units, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM r
), p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p""")
def op12_fill_in_middle(spark, sf_dir):
    """Every text cut at two drawn line ends, and put together again from what came out."""
    bound_batches(spark)
    made = table(spark, sf_dir, "documents").select("doc_id", fill_middle.fill_in_middle(F.col("doc_id"), F.col("text")).alias("r"))
    return made.select(
        "doc_id", "r.n", "r.form", "r.prefix_chars", "r.middle_chars", F.sha2("r.output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(F.col("r.output"), F.col("r.form")), 256).alias("restored_sha256"),
    )


@query(r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
           CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), seen AS (
  SELECT id, run, count(*) AS times, hex(encode(id || ':' || run)) AS code FROM runs GROUP BY id, run
), drawn AS (
  SELECT run, times, xor(4294967295, list_reduce(
           list_transform(range(1, length(code), 2), lambda k: CAST('0x' || substr(code, k, 2) AS BIGINT)),
           lambda c, byte: xor(c >> 8, t[1 + xor(c % 256, byte)]), 4294967295)) AS draw
  FROM seen, tab
), words AS (
  SELECT CASE WHEN draw % 97 = 0 THEN substr(run, 1, draw % length(run)) || substr(run, 2 + draw % length(run)) ELSE run END AS word,
         CAST(sum(times) AS BIGINT) AS n
  FROM drawn GROUP BY 1 HAVING length(word) >= 5 AND sum(times) >= 3
), less AS (
  SELECT DISTINCT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
), longer AS (
  SELECT DISTINCT l.word, l.n, w.word AS near, w.n AS near_n FROM less l JOIN words w ON l.rest = w.word
), near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION ALL SELECT * FROM longer UNION ALL SELECT near, near_n, word, n FROM longer
), best AS (
  SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) = 1
), formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * words.n THEN near END AS form,
         CASE WHEN near_n >= 2 * words.n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.next = f.word
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL""")
def op13_spelling_variants(spark, sf_dir):
    """Words of all texts with their more frequent forms one edit away."""
    return spelling.variant_groups(table(spark, sf_dir, "documents"), drop_every=97)
