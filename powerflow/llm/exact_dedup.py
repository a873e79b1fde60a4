"""Exact duplicates by content-defined chunk recipes.

A text without its blanks is cut where its own content says so, so equal stretches give equal chunks. Chunks
are deduplicated to verified identifiers, and a document becomes the ordered list of its chunks'
identifiers, its recipe. Documents are equal exactly if their recipes are. Texts are read once and never
shuffled; what moves are hashes, about 50 bytes for each chunk.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.llm.common import documents_of, keep_marked
from powerflow.operators.grouping import fact_join
from powerflow.session import written

# A chunk ends after ten bytes whose lowest bits follow one of these patterns, but not before MIN_CHUNK bytes. In text of
# any script, in digits and in encoded data the lowest bits vary, so such places come every few hundred bytes and texts
# that differ at their begin are soon cut at the same places. The patterns repeat a bit at every second or third place, as
# the letters of some scripts all begin with the same byte or two. Where none follows, MAX_CHUNK is the end.
BOUNDARY_BITS = ("1000101000", "0111010111", "1001001001")
MIN_CHUNK = 256
MAX_CHUNK = 8192


def _boundary() -> str:
    """A regular expression for the bytes before a boundary, each as the character of its number."""
    with_bit = {str(bit): "[" + "".join(f"\\x{byte:02X}" for byte in range(bit, 256, 2)) + "]" for bit in (0, 1)}
    return "|".join("".join(with_bit[bit] for bit in bits) for bits in BOUNDARY_BITS)


def without_blanks(text: Column) -> Column:
    return F.regexp_replace(text, "[ \\t-\\r]+", "")


def chunks_of(text: Column) -> Column:
    """The text's UTF-8 bytes as an array of content-defined chunks; an empty text has none.

    A byte is the character of its number, so characters may be cut within, and different texts have different chunks.
    """
    as_bytes = F.decode(text.cast("binary"), "ISO-8859-1")
    width = len(BOUNDARY_BITS[0])
    pattern = f"(?s).{{{MIN_CHUNK - width},{MAX_CHUNK - width}}}?(?:{_boundary()})|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(as_bytes, F.lit(pattern), F.lit(0))


def chunk_table(documents: DataFrame) -> DataFrame:
    """A row for each chunk of each document, in the shared folder.

    ``place`` is the chunk's number and NULL in the one row of an empty text. The document's digest and
    length stand in its first row only.
    """
    docs = documents_of(documents).withColumn("bare", without_blanks(F.col("text")))
    parts = F.transform(
        chunks_of(F.col("bare")),
        lambda c: F.struct(
            F.xxhash64(c).alias("hash"), F.length(c).alias("bytes"), F.unhex(F.sha2(c, 256)).alias("sha")
        ),
    )
    rows = docs.select(
        "id", "text_key", F.length("text").alias("length"), F.sha2("bare", 256).alias("text_sha256"), parts.alias("parts")
    ).select("id", "text_key", "length", "text_sha256", F.posexplode_outer("parts").alias("place", "part"))
    first = F.coalesce("place", F.lit(0)) == 0
    return written(
        rows.select(
            "id", "text_key", "place", "part.*",
            F.when(first, F.col("length")).alias("length"),
            F.when(first, F.col("text_sha256")).alias("text_sha256"),
        ),
        "chunks",
    )


def recipes(chunks: DataFrame) -> DataFrame:
    """Distinct documents with their recipes and the number of rows they stand for.

    A chunk's identifier is its 64-bit hash and size, verified by SHA-256: where several contents share hash and
    size, the digest becomes part of the identifier.
    """
    contents = chunks.filter("place IS NOT NULL").select("hash", "bytes", "sha").distinct()
    shared = contents.groupBy("hash", "bytes").agg(F.count("*").alias("contents")).filter("contents > 1")
    named = fact_join(chunks, shared, ["hash", "bytes"], "left").select(
        "id", "text_key", "length", "text_sha256", "place",
        F.struct("hash", "bytes", F.when(F.col("contents") > 1, F.col("sha")).alias("sha")).alias("chunk"),
    )
    # equal rows of the table give equal chunk rows, which count once in the recipe
    return named.groupBy("id", "text_key").agg(
        F.max("length").alias("length"), F.max("text_sha256").alias("text_sha256"),
        F.count("length").alias("n_rows"),
        F.collect_set(F.when(F.col("place").isNotNull(), F.struct("place", "chunk"))).alias("chunks"),
    ).withColumn("recipe", F.array_sort("chunks")["chunk"]).drop("chunks")


def duplicates(documents: DataFrame) -> DataFrame:
    """Group, keeper and digest of each row of the documents.

    Columns ``id``, ``text_key``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``. Of equal
    texts the one with the most code points stays, then the smallest id, NULL last; of rows equal
    in id and text too, one. NULL counts as empty, and all texts of blanks alone are equal.
    """
    docs = recipes(chunk_table(documents))
    order = F.struct(
        (-F.col("length")).alias("length"), F.col("id").isNull().alias("none"), F.col("id"), F.col("text_key")
    )
    groups = docs.groupBy("recipe").agg(F.min(order).alias("keep"), F.sum("n_rows").alias("group_size"))
    joined = fact_join(docs, groups, "recipe", "inner")
    first = F.col("id").eqNullSafe(F.col("keep.id")) & (F.col("text_key") == F.col("keep.text_key"))
    return joined.select(
        "id", "text_key", F.col("keep.id").alias("keep_id"), "group_size", first.alias("stays"), "text_sha256",
        F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("copy"),
    ).select(
        "id", "text_key", "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "text_sha256",
        "copy",
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of each group of equal texts, all columns kept."""
    return keep_marked(documents, written(duplicates(documents), "duplicates"))
