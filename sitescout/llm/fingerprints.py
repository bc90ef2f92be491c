"""Document fingerprints by Order MinHash.

A text is cut at white space into pieces of up to twelve characters, and ``k`` pieces in a row are
a k-mer. Repeats of a k-mer are numbered in text order, which makes them all different. Every
numbered k-mer is hashed and dealt by that hash to one of the fingerprint's slots; each slot keeps the ``per_slot`` smallest hashes, puts them back into text order, and hashes them as a
tuple. So a slot changes when k-mers are replaced, repeated or put in another order, and the
share of equal slots follows the edit distance. One hash serves all slots: it is one permutation,
split into slots, in place of one permutation per slot.

Null texts count as empty. A text with no k-mer has empty slots only; two such texts are alike.
A text shorter than ``k`` pieces is one k-mer. Equal texts have equal fingerprints. Everything
here is built-in expressions on one row, except ``with_next``, which moves each text once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitescout.llm.common import broadcast_if_small, stored

K, SLOTS, PER_SLOT = 3, 64, 2
PIECE = r"\S{1,12}\s*|\s+"
#: A hash keeps its upper bits and no sign, so that a position fits below them.
PLACE_BITS = 24
PLACE, HASH = (1 << PLACE_BITS) - 1, ((1 << 63) - 1) ^ ((1 << PLACE_BITS) - 1)
SLOT_HASH_BITS = 31
DOCS_PER_RANGE, MOST_CUTS = 4_000, 8


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _with_place(hashed: Column, place: Column) -> Column:
    """39 bits of a hash above a place. Sorting these numbers sorts by hash, then by place."""
    return hashed.bitwiseAND(F.lit(HASH)).bitwiseOR(place)


def _kmers(pieces: Column, k: int) -> Column:
    """The k-mers, each hashed with its place, in order of hash: equal ones stand together."""
    last = F.greatest(F.size(pieces) - k, F.lit(0))
    places = F.when(F.size(pieces) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def kmer(i: Column) -> Column:
        return F.xxhash64(*[F.get(pieces, i + j) for j in range(k)])

    return F.sort_array(F.transform(places, lambda i: _with_place(kmer(i), i.cast("long"))))


def _numbered(ordered: Column) -> Column:
    """Repeats of a k-mer hashed anew with their number, in order of hash. The first stays."""

    def same_in(array: Column):
        return lambda x, i: (i > 0) & (F.get(array, i - 1).bitwiseXOR(x) <= F.lit(PLACE).cast("long"))

    def renumbered(repeats: Column) -> Column:
        starts = F.filter(
            F.transform(repeats, lambda x, i: F.when(same_in(repeats)(x, i), F.lit(-1)).otherwise(i)), lambda i: i >= 0
        )

        def run(starts: Column) -> Column:
            def number(s: Column, j: Column) -> Column:
                return F.transform(
                    F.slice(repeats, s + 1, F.coalesce(F.get(starts, j + 1), F.size(repeats)) - s),
                    lambda x, n: _with_place(F.xxhash64(x.bitwiseAND(F.lit(HASH)), n), x.bitwiseAND(F.lit(PLACE))),
                )

            return F.flatten(F.transform(starts, number))

        firsts = F.filter(ordered, lambda x, i: ~same_in(ordered)(x, i))
        return F.when(F.size(repeats) == 0, ordered).otherwise(F.sort_array(F.concat(firsts, _let(starts, run))))

    return _let(F.filter(ordered, same_in(ordered)), renumbered)


def _smallest(ordered: Column, per_slot: int, slot_shift: int) -> Column:
    """The ``per_slot`` smallest hashes of each slot, which the upper bits of the hash name."""
    return F.filter(
        ordered,
        lambda x, i: (i < per_slot) | (F.get(ordered, i - per_slot).bitwiseXOR(x) >= F.lit(1 << slot_shift)),
    )


def _tuples(kept: Column, per_slot: int, slot_shift: int) -> Column:
    """For each slot that is not empty its number above the hash of its k-mers in text order."""

    def slot(x: Column, i: Column) -> Column:
        own = F.filter(F.slice(kept, i + 1, per_slot), lambda y: y.bitwiseXOR(x) < F.lit(1 << slot_shift))
        by_place = F.sort_array(F.transform(own, lambda y: F.struct(y.bitwiseAND(F.lit(PLACE)), y.bitwiseAND(F.lit(HASH)).alias("h"))))
        hashed = F.shiftrightunsigned(F.xxhash64(F.transform(by_place, lambda y: y["h"])), 64 - SLOT_HASH_BITS)
        return F.shiftleft(F.shiftright(x, slot_shift), SLOT_HASH_BITS).bitwiseOR(hashed)

    opens = F.transform(
        kept,
        lambda x, i: F.when((i == 0) | (F.get(kept, i - 1).bitwiseXOR(x) >= F.lit(1 << slot_shift)), slot(x, i)),
    )
    return F.filter(opens, lambda x: x.isNotNull())


def signature(text: Column, k: int = K, slots: int = SLOTS, per_slot: int = PER_SLOT) -> Column:
    """The used slots of a text in order: their numbers above 31 bits of hash. ``slots``: a power of 2."""
    shift = 63 - (slots.bit_length() - 1)
    value = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), 0)
    for step in (
        lambda a: _kmers(a, k),
        _numbered,
        lambda a: _smallest(a, per_slot, shift),
        lambda a: _tuples(a, per_slot, shift),
    ):
        value = _let(value, step)
    return value


def as_text(slots: Column) -> Column:
    """Ten hexadecimal digits for each used slot."""
    return F.lower(F.array_join(F.transform(slots, lambda x: F.lpad(F.hex(x), 10, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal slots among those that either text uses; 1 if neither uses any."""

    def number(x: Column) -> Column:
        return F.shiftright(x, SLOT_HASH_BITS)

    used = F.size(F.array_union(F.transform(a, number), F.transform(b, number)))
    return F.when(used > 0, F.size(F.array_intersect(a, b)) / used).otherwise(F.lit(1.0))


def with_next(docs: DataFrame, columns: list[str], docs_per_range: int = DOCS_PER_RANGE) -> DataFrame:
    """``docs`` (doc_id, _text_hash, ...) with ``next_<column>`` of the next row by id and hash.

    After the last comes the first. Rows are cut into ranges of some ``docs_per_range`` rows; the first
    row of each is also sent to the range before it, as its end. A range is named by an array: the
    equal parts of all ids, then, where a part has far too many rows because ids lie unevenly, the equal
    parts of that part's ids, and so on; rows of one id, or without one, are parted by the hash of
    their text. Null ids come first. Numbers are decimals, as differences of ids can exceed 64 bits.
    """
    ranged = docs.withColumn("_range", F.array().cast("array<decimal(38,0)>"))
    for _ in range(MOST_CUTS):
        stats = ranged.groupBy("_range").agg(
            F.count("*").alias("_n"),
            *[f(c).cast("decimal(38,0)").alias(n) for c, ns in (("doc_id", ("_low", "_high")), ("_text_hash", ("_low2", "_high2"))) for f, n in zip((F.min, F.max), ns)],
            F.max(F.col("doc_id").isNull()).alias("_has_null"),
        )
        crowded = stored(stats.where((F.col("_n") > 4 * docs_per_range) & ((F.col("_low") < F.col("_high")) | (F.col("_low2") < F.col("_high2")))))
        if crowded.isEmpty():
            break

        def part(value: str, low: str, high: str) -> Column:
            width = F.greatest(F.ceil((F.col(high) - F.col(low) + 1) * docs_per_range / F.col("_n")), F.lit(1))
            return F.floor((F.col(value).cast("decimal(38,0)") - F.col(low)) / width).cast("decimal(38,0)")

        by_id = F.coalesce(part("doc_id", "_low", "_high"), F.lit(-1).cast("decimal(38,0)"))
        ids_differ = (F.col("_low") < F.col("_high")) | (F.col("_has_null") & F.col("_low").isNotNull())
        place = F.when(F.col("_n").isNull(), F.lit(0).cast("decimal(38,0)")).when(ids_differ, by_id).otherwise(part("_text_hash", "_low2", "_high2"))
        joined = ranged.join(broadcast_if_small(crowded), "_range", "left")
        ranged = joined.withColumn("_range", F.concat("_range", F.array(place))).drop(*[c for c in crowded.columns if c != "_range"])
    heads = ranged.groupBy("_range").agg(F.min(F.struct("doc_id", "_text_hash")).alias("_head"))
    order = Window.orderBy("_range")
    last = F.max("_range").over(Window.partitionBy())
    heads = heads.select(
        F.col("_head.doc_id").alias("_id"),
        F.col("_head._text_hash").alias("_hash"),
        F.coalesce(F.lag("_range").over(order), last).alias("_end_of"),
    )
    heads = broadcast_if_small(stored(heads))
    is_head = ranged["doc_id"].eqNullSafe(heads["_id"]) & (ranged["_text_hash"] == heads["_hash"])
    places = F.when(F.col("_end_of").isNull(), F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("e")))).otherwise(
        F.array(
            F.struct(F.col("_range").alias("r"), F.lit(False).alias("e")),
            F.struct(F.col("_end_of").alias("r"), F.lit(True).alias("e")),
        )
    )
    dealt = ranged.join(heads, is_head, "left").drop("_id", "_hash").withColumn("_place", F.explode(places))
    dealt = dealt.withColumns({"_range": F.col("_place.r"), "_is_end": F.col("_place.e")}).drop("_place", "_end_of")
    following = Window.partitionBy("_range").orderBy("_is_end", "doc_id", "_text_hash")
    ahead = dealt.select("*", *[F.lead(c).over(following).alias(f"next_{c}") for c in columns])
    return ahead.where("not _is_end").drop("_range", "_is_end")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n / 2) characters replaced by the first of the next text.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.select("*", F.xxhash64("text").alias("_text_hash"), signature(F.col("text")).alias("slots"))
    paired = with_next(own, ["text", "slots"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    paired = paired.select("doc_id", n.cast("long").alias("n_chars"), "slots", "next_slots", edited.alias("edited"))
    paired = paired.select("*", signature(F.col("edited")).alias("edited_slots"))
    return paired.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("slots")).alias("fingerprint"),
        as_text(F.col("edited_slots")).alias("edited_fingerprint"),
        likeness(F.col("slots"), F.col("edited_slots")).alias("near_edited"),
        likeness(F.col("slots"), F.col("next_slots")).alias("near_next"),
    )
