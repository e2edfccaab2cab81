"""Document fingerprints by winnowing, in DataFrame functions only.

A unit is a word, or, of a word of more than ``LONG`` characters, each piece of ``PIECE`` consecutive characters, so that scripts and
encodings without spaces are told apart too.  Every ``GRAM`` consecutive units have a hash; of every ``WINDOW`` consecutive hashes the
smallest is chosen, the rightmost of equal ones, and kept with its position (unit number).  Two texts that share ``GRAM + WINDOW - 1`` words in
a row share a chosen hash, and so do two that share ``PIECE + GRAM + WINDOW - 2`` characters in a row inside long words.  Texts with fewer
units keep all of their hashes, or have one gram.

A chosen entry is one long: 32 bits of hash above 31 bits of (2^31 - 1 - position).  So the minimum of longs is the smallest
hash with the rightmost position, and the minimum over a window is built from shifted copies in as many steps as the width has doublings.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Work and memory are linear in a text, also in a very long one, which one task has to hold.  The likeness of two texts is the Jaccard index of their chosen hashes; texts without words are alike
(1) to each other and unlike (0) to others.  Null texts are empty texts.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yearring.llm.parts import written

GRAM = 3
WINDOW = 4
#: Words beyond this many characters are taken in overlapping pieces.
LONG = 40
PIECE = 10
_TOP = 2**31 - 1
#: Ids of a block of neighbours are equal but for this many low bits.
BLOCK_BITS = 12


def words(text: Column) -> Column:
    """The words of a text as an array."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def units(text: Column) -> Column:
    """The words of a text, and the pieces of its long words."""
    pieces = lambda w: F.regexp_extract_all(w, F.lit(f"(?s)(?=(.{{{PIECE}}}))."), F.lit(1))
    is_long = lambda w: F.length(w) > LONG
    taken = lambda ws: F.flatten(F.transform(ws, lambda w: F.when(is_long(w), pieces(w)).otherwise(F.array(w))))
    return _let(words(text), lambda ws: F.when(F.exists(ws, is_long), taken(ws)).otherwise(ws))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def fingerprint(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Chosen entries of a text, by position."""

    def hashes(w: Column) -> Column:
        last = F.size(w) - gram
        whole = F.array(F.xxhash64(F.array_join(w, " ")))
        each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(gram)]))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(last < 0, whole).otherwise(each)

    packed = _let(
        units(text),
        lambda w: F.transform(hashes(w), lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 32), 31) + (F.lit(_TOP) - i).cast("long")),
    )

    def pairwise(step: int):
        return lambda e: F.zip_with(F.slice(e, 1, F.size(e) - step), F.slice(e, step + 1, F.size(e) - step), lambda a, b: F.least(a, b))

    def least(entries: Column, width: int) -> Column:
        reach = 1
        while reach < width:
            step = min(reach, width - reach)
            entries = _let(entries, pairwise(step))
            reach += step
        return entries

    return _let(packed, lambda e: F.array_distinct(F.when(F.size(e) >= window, least(e, window)).otherwise(e)))


def hashes_of(entries: Column) -> Column:
    return F.array_distinct(F.transform(entries, lambda e: F.shiftright(e, 31)))


def rendered(entries: Column) -> Column:
    """``hash@position`` in hexadecimal, by position."""
    return F.array_join(
        F.transform(entries, lambda e: F.concat(F.hex(F.shiftright(e, 31)), F.lit("@"), F.hex(F.lit(_TOP) - e.bitwiseAND(F.lit(_TOP).cast("long"))))), " "
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of the hashes of two fingerprints."""

    def index(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        common = F.size(F.array_intersect(x, y))
        union = F.size(x) + F.size(y) - common
        return F.when(union == 0, 1.0).otherwise(common / union)

    return _let(F.struct(hashes_of(a).alias("x"), hashes_of(b).alias("y")), index)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id, entries`` (array of ``hash, position``), one row per row of ``df``."""
    entries = F.transform(
        fingerprint(F.coalesce(F.col(text_col), F.lit("")), gram, window),
        lambda e: F.struct(F.shiftright(e, 31).alias("hash"), (F.lit(_TOP) - e.bitwiseAND(F.lit(_TOP).cast("long"))).cast("int").alias("position")),
    )
    return df.select(F.col(id_col).cast("long").alias("doc_id"), entries.alias("entries"))


def neighbours(ids: DataFrame) -> DataFrame:
    """``id, next_id`` of distinct ids: the next smaller one, and after the smallest the largest.

    Works level by level over ranges of 2^16 ids, 2^16 ranges and so on, so no window holds more than 2^16 rows.
    """
    level = ids.select("id", F.col("id").alias("top"), F.col("id").alias("bottom"))
    steps = []
    for _ in range(4):
        level = level.withColumn("range", F.shiftright("id", 16))
        w = Window.partitionBy("range").orderBy(F.desc("id"))
        steps.append(level.select(F.col("bottom").alias("id"), F.lead("top").over(w).alias("next_id")).filter("next_id IS NOT NULL"))
        level = level.groupBy("range").agg(F.max("top").alias("top"), F.min("bottom").alias("bottom")).withColumnRenamed("range", "id")
    # At most two ranges are left: negative ids and others.
    all_ids = Window.partitionBy(F.lit(0))
    step = F.coalesce(F.lead("top").over(all_ids.orderBy(F.desc("id"))), F.max("top").over(all_ids))
    out = level.select(F.col("bottom").alias("id"), step.alias("next_id"))
    for more in steps:
        out = out.union(more)
    return out


def with_next(df: DataFrame, id_col: str, text_col: str, entries, bits: int = BLOCK_BITS) -> DataFrame:
    """``doc_id, text, prints, next`` (text and prints of the next row); ``entries`` makes prints from a text.

    Rows are ordered by descending id, then descending text, and after the last comes the first.  They are dealt into blocks of neighbouring
    ids, so texts move once; each block also gets the first row of the next block as a guest.
    Rows with a null id have no place in the order: their next text is empty.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.lit(False).alias("guest"))
    placed = docs.filter("doc_id IS NOT NULL").withColumn("block", F.shiftright("doc_id", bits))
    blocks = written(placed.select(F.col("block").alias("id")).distinct(), "blocks")
    tops = placed.groupBy(F.col("block").alias("next_id")).agg(F.max(F.struct("doc_id", "text")).alias("top"))
    guests = tops.join(neighbours(blocks), "next_id").select("top.doc_id", "top.text", F.lit(True).alias("guest"), F.col("id").alias("block"))
    order = Window.partitionBy("block").orderBy("guest", F.desc("doc_id"), F.desc("text"))
    dealt = placed.union(guests).repartition("block").withColumn("prints", entries(F.col("text")))
    led = dealt.withColumn("next", F.lead(F.struct("text", "prints")).over(order)).filter(~F.col("guest")).select("doc_id", "text", "prints", "next")
    alone = docs.filter("doc_id IS NULL").select("doc_id", "text", entries(F.col("text")).alias("prints"))
    return led.union(alone.withColumn("next", F.struct(F.lit("").alias("text"), F.array().cast("array<bigint>").alias("prints"))))


def compared(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each row's fingerprint beside those of an edited text and of the next document.

    The edited text has its last half replaced by the beginning of the next document: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next.text", half))
    pairs = with_next(df, id_col, text_col, lambda text: fingerprint(text, gram, window))
    both = pairs.select("doc_id", n.cast("long").alias("n_chars"), "prints", F.col("next.prints").alias("next_prints"), edited.alias("edited"))
    both = both.withColumn("edited_prints", fingerprint(F.col("edited"), gram, window))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        rendered(F.col("prints")).alias("fingerprint"),
        rendered(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
        likeness(F.col("prints"), F.col("next_prints")).alias("near_next"),
    )
