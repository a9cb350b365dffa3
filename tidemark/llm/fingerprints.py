"""Document fingerprints from closed syncmers, in DataFrame operations only.

A text is cut into pieces (runs without white space, at most ``PIECE`` characters long). Of every ``K`` pieces in
a row, a k-mer, the neighbouring pairs are hashed; the k-mer is an anchor if the least of its pairs is the
first or the last one. Whether a k-mer is an anchor depends on nothing around it, so an edit moves or changes
only anchors that touch it. The fingerprint is all anchors of the pieces with ``K - 1`` blank pieces before and behind
them, each as a hash with its place. As one of any four neighbouring k-mers is an anchor, every text of one
piece or more has some, and texts of all lengths are compared in this one form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import range_bounds, range_of, shuffle_parts

PIECE = 8
K = 6
#: Pieces by which the shifts of matching anchors that follow one another may differ.
SHIFT = 8


def pieces(text: Column) -> Column:
    """The hash of each piece of a text, in order."""
    found = F.regexp_extract_all(text, F.lit(rf"\S{{1,{PIECE}}}"), F.lit(0))
    return F.transform(found, lambda p: F.xxhash64(p))


def anchors(text: Column) -> Column:
    """All anchors of a text as longs, the hash in the upper half and the place in the lower one, sorted.

    Equal k-mers all count: the hash of a later one is also of how many stand before it. Below ``K`` pieces, none.
    """
    return _with(pieces(text), _syncmers)


def _pack(h: Column, i: Column) -> Column:
    return F.shiftleft(h.bitwiseAND(F.lit(0x7FFFFFFF)), 32).bitwiseOR(i.cast("long"))


def _syncmers(h: Column) -> Column:
    pairs = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1)))

    def of_pairs(s: Column) -> Column:
        def at(i: Column) -> Column:
            edge = F.least(F.get(s, i), F.get(s, i + K - 2))
            inner = F.least(*[F.get(s, i + j) for j in range(1, K - 2)])
            return F.when(edge <= inner, _pack(F.xxhash64(*[F.get(h, i + j) for j in range(K)]), i))

        return F.transform(F.sequence(F.lit(0), F.size(h) - K), at)

    found = F.when(F.size(h) >= K, _with(pairs, of_pairs)).otherwise(F.array().cast("array<bigint>"))
    return _told_apart(F.array_compact(found))


def _told_apart(packed: Column) -> Column:
    """Sorted, with another hash for every further one of equal hashes."""

    def of_sorted(a: Column) -> Column:
        starts = F.filter(F.transform(a, lambda x, i: F.when((i == 0) | (_hash(x) != _hash(F.get(a, i - 1))), i)), lambda i: i.isNotNull())

        def of_starts(s: Column) -> Column:
            run = lambda at, k: F.slice(a, at + 1, F.coalesce(F.get(s, k + 1), F.size(a)) - at)
            named = lambda x, n: F.when(n == 0, x).otherwise(_pack(F.xxhash64(_hash(x), n), _place(x)))
            return F.flatten(F.transform(s, lambda at, k: F.transform(run(at, k), named)))

        return F.when(F.size(starts) == F.size(a), a).otherwise(F.sort_array(_with(starts, of_starts)))

    return _with(F.sort_array(packed), of_sorted)


def _with(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hash(anchor: Column) -> Column:
    return F.shiftright(anchor, 32)


def _place(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit(0xFFFFFFFF))


def sketch(text: Column) -> Column:
    """The fingerprint: the anchors of the text between blank pieces, as sorted packed longs; none without a piece.

    The place of an anchor is that of its k-mer's last piece, so those that reach over the end lie behind all pieces.
    """
    blank = F.array_repeat(F.lit(0).cast("long"), K - 1)
    between = lambda h: F.when(F.size(h) > 0, F.concat(blank, h, blank)).otherwise(h)
    return _with(_with(pieces(text), between), _syncmers)


def printed(fingerprint: Column) -> Column:
    """Hash and place of each anchor in hexadecimal digits."""
    one = lambda a: F.concat_ws(":", F.lower(F.hex(_hash(a))), F.lower(F.hex(_place(a))))
    return F.array_join(F.transform(fingerprint, one), ",")


def likeness(a: Column, b: Column) -> Column:
    """Share of the anchors of two fingerprints that both have in runs of like shifts; 1 for two without anchors.

    A matching anchor counts if the one before or behind it in the first text is shifted alike, or if it is the
    only one; so words put in or taken out between two runs cost nothing but themselves.
    """

    def compared(x: Column, y: Column) -> Column:
        side = lambda c, n: F.transform(c, lambda v: _pack(_hash(v), F.shiftleft(_place(v), 1).bitwiseOR(F.lit(n).cast("long"))))
        met = lambda s: F.array_compact(F.transform(s, lambda v, i: F.when((i > 0) & (_hash(v) == _hash(F.get(s, i - 1))) & (v % 2 != F.get(s, i - 1) % 2), both(v, F.get(s, i - 1)))))
        half = lambda v: F.shiftright(_place(v), 1)
        both = lambda v, w: F.when(v % 2 == 1, _pack(half(w), half(v))).otherwise(_pack(half(v), half(w)))

        def in_runs(m: Column) -> Column:
            shift = lambda v: _hash(v) - _place(v)
            alike = lambda v, i: F.coalesce(F.abs(shift(v) - shift(F.get(m, i))) <= SHIFT, F.lit(False))
            return F.size(F.filter(m, lambda v, i: (F.size(m) == 1) | alike(v, i - 1) | alike(v, i + 1)))

        matches = _with(F.sort_array(_with(F.sort_array(F.concat(side(x, 0), side(y, 1))), met)), lambda m: F.struct(F.size(m).alias("met"), in_runs(m).alias("runs")))
        share = lambda n: F.when(F.size(x) + F.size(y) == 0, 1.0).otherwise(n["runs"] / (F.size(x) + F.size(y) - n["met"]))
        return _with(matches, share)

    sides = F.struct(a.alias("a"), b.alias("b"))
    return _with(sides, lambda f: compared(f["a"], f["b"]))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text, anchors`` per row, ``anchors`` the whole fingerprint; null texts count as empty. One narrow stage."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("anchors", sketch(F.col("text")))


def with_next(rows: DataFrame, columns: list[str], parts: int | None = None, made: dict[str, Column] | None = None) -> DataFrame:
    """``rows`` with ``next_<column>`` of the row with the next smaller doc_id; after the last comes the first.

    The columns ``made`` are worked out behind the shuffle, once for each row, and handed on likewise.

    Null ids come last, rows with equal ids in the order of their ``columns``. Rows are dealt into ranges of ids;
    each range also gets the first row of the range that follows, so the order needs one shuffle and no
    task holds more than a range. Only the largest id of each range reaches the driver.
    """
    parts = parts or shuffle_parts(rows.sparkSession)
    bounds = range_bounds(rows, "doc_id", parts)
    placed = rows.withColumn("range", range_of(F.col("doc_id"), bounds))
    firsts = placed.groupBy("range").agg(F.max("doc_id").alias("first")).orderBy(F.desc("range")).collect()
    targets = [firsts[-1].range if firsts else 0] + [r.range for r in firsts[:-1]]  # where each range's first row goes too
    copies = F.array(*[F.when((F.col("range") == r.range) & F.col("doc_id").eqNullSafe(F.lit(r.first).cast("long")), F.struct(F.lit(t).alias("range"), F.lit(1).alias("copy"))) for r, t in zip(firsts, targets)])
    own = F.array(F.struct("range", F.lit(0).alias("copy")))
    goes = F.concat(own, F.array_compact(copies)) if firsts else own
    made = made or {}
    order = ["copy", F.col("doc_id").desc_nulls_last(), *columns]
    dealt = placed.select(*rows.columns, F.explode(goes).alias("at")).select(*rows.columns, "at.*")
    dealt = dealt.repartitionById(parts, "range").sortWithinPartitions("range", *order).withColumns(made)
    window = Window.partitionBy("range").orderBy(*order)
    following = dealt.select(*rows.columns, *made, "copy", *[F.lead(c).over(window).alias(f"next_{c}") for c in (*columns, *made)])
    return following.filter("copy = 0").drop("copy")


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of the next one and of the text with its last third taken from the next one.

    Only texts are shuffled; fingerprints are made behind it, and those of next texts are handed on. Null texts count
    as empty. Null ids come last, rows with equal ids follow one another in the order of their texts; the only row
    of a table is its own next one, and an empty table gives no rows. Other columns are not read.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(texts, ["text"], made={"anchors": sketch(F.col("text"))})
    n = F.char_length("text").cast("long")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n.cast("int") - third), F.substring(F.col("next_text"), F.lit(1), third))
    edits = rows.select("doc_id", n.alias("n_chars"), edited.alias("edited"), "anchors", "next_anchors")
    return edits.withColumn("edited_anchors", sketch(F.col("edited")))
