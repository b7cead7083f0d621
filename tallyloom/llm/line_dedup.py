"""Lines that many documents share, dropped from all of them.

1. Texts are cut at line feeds and the lines exploded with their positions. A line's key is the line
   without white space around it, A-Z in lower case; from here on a key is its 128-bit digest.
2. The documents of each digest are counted over all texts: distinct (digest, document) pairs first, which
   spreads a line that every document has, then pairs per digest, combined before the shuffle.
3. Positions whose digest is in too many documents are gathered per text: numbers, not lines, so what
   one text gathers is bounded by its own length.
4. Each text meets its positions and is put together from the lines at all others, in order.

Texts are shuffled once, in step 4; steps 2 and 3 move digests. A text is known by its id and its digest, so
rows that repeat an id with another text keep apart, and rows that repeat both share one answer.

Defined cases: a null or empty text is one empty line and stays as it is; keys shorter than asked, empty
ones first of all, are never dropped; a text that loses all its lines becomes empty; documents are told
apart by id, all null ids together count as one document; an empty table gives an empty result. The
columns of the input stay as they are, also those named like results: those carry the prefix OWN.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import joined

OWN = "_line_dedup_"
BLANKS = " \t\n\x0b\x0c\r"  # \x20 and \x09 to \x0D


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """The line stripped of blanks, A-Z in lower case; letters outside ASCII stay as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    plain = F.octet_length(bare) == F.char_length(bare)  # only ASCII: the fast way is exact
    return F.when(plain, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _lines(docs: DataFrame, shortest: int) -> DataFrame:
    """(id, text, position, line) of lines whose key is long enough, key and text as digests."""
    exploded = docs.select("id", F.md5("text").alias("text"), F.posexplode(lines_of(F.col("text"))))
    keyed = exploded.select("id", "text", F.col("pos").alias("position"), key_of(F.col("col")).alias("key"))
    return keyed.where(F.char_length("key") >= max(shortest, 1)).select(
        "id", F.unhex("text").alias("text"), "position", F.unhex(F.md5("key")).alias("line"))


def common_lines(lines: DataFrame, documents: int) -> DataFrame:
    """(line, n_documents) of the digests found in at least so many documents."""
    return (lines.select("line", "id").distinct().groupBy("line")
            .agg(F.count("*").alias("n_documents")).where(F.col("n_documents") >= documents))


def drop_common_lines(docs: DataFrame, documents: int = 10, shortest: int = 1, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """``docs`` with OWN + n_lines (before dropping), n_dropped and kept, the text that remains.

    Lines whose key has at least ``shortest`` characters and is found in at least ``documents``
    documents go, in every document that has them.
    """
    named = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    lines = _lines(named, shortest)
    found = joined(lines, common_lines(lines, documents), ["line"])
    drops = found.groupBy("id", "text").agg(F.collect_set("position").alias(OWN + "gone")).select(
        F.col("id").alias(OWN + "id"), F.col("text").alias(OWN + "digest"), OWN + "gone")
    marked = docs.withColumns({OWN + "id": F.col(f"`{key}`"), OWN + "digest": F.unhex(F.md5(f"`{text}`"))})
    met = joined(marked, drops, [OWN + "id", OWN + "digest"], "left")
    # A generator, so that the text is cut once and not in every use of its lines.
    cut = met.select("*", F.explode(F.array(lines_of(F.col(f"`{text}`")))).alias(OWN + "lines"))
    lines_here, gone = F.col(OWN + "lines"), F.col(OWN + "gone")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines_here) - 1), gone)
    kept = F.array_join(F.transform(left, lambda i: F.get(lines_here, i)), "\n")
    return cut.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size(lines_here).cast("long").alias(OWN + "n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(OWN + "n_dropped"),
        F.when(gone.isNull(), F.col(f"`{text}`")).otherwise(kept).alias(OWN + "kept"))


def oracle(documents: int = 10, shortest: int = 1) -> str:
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return f"""
        with docs as (
          select row_number() over () as row_id, doc_id,
                 string_split(coalesce(text, ''), chr(10)) as parts from documents),
        cut as (
          select row_id, doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as position from docs),
        keyed as (select *, translate(trim(line, {blanks}), '{upper}', '{lower}') as key from cut),
        common as (
          select key from (select distinct key, doc_id from keyed where length(key) >= {shortest}) pairs
          group by key having count(*) >= {documents})
        select any_value(k.doc_id) as doc_id, count(*) as n_lines, count(c.key) as n_dropped,
               sha256(coalesce(string_agg(k.line, chr(10) order by k.position)
                                 filter (where c.key is null), '')) as kept_sha256
        from keyed k left join common c on c.key = k.key group by k.row_id"""
