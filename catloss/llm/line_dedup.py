"""Line dedup through deletion neighbourhoods.

A line goes if an earlier line, by (doc_id, position), equals it or is within one word
edit of it (a word inserted, deleted or replaced); of equal lines the earliest stays.
Lines of fewer than ``MIN_WORDS`` words go only if equal to an earlier one, but a line of
``MIN_WORDS`` words goes also for an earlier one of a word less; lines without a word stay.

Deleting a word from both of two lines within the bound leaves equal variants, but all
variants of all lines are as many as the words. So the search has two levels. First, a
line is cut into blocks after words chosen by their hash, which an edit can only change
locally: one edit touches one block, or two neighbours. The variants without one block or
without two neighbours are emitted as hashed keys; lines that share none have no partner.
Second, the lines that share a key emit the variants without one word: two lines that
agree on the rest, its length and the deleted position differ by a replacement; a line
that equals another's variant differs by an insertion. Each key's lines are linked to its
earliest, so large groups need no pairs, and the edit distance of every link is verified
on the words.

The cut rate halves with each doubling of a line's length, so that a line has 5 to 9
blocks as a rule; lengths at a border emit the keys of both rates, and lines of one or two
blocks (few distinct words) those of finer cuts.

Only DataFrame functions are used. Defined cases: null text has no lines and stays null;
a null doc_id comes after all others; rows with equal doc_id and text count as one
document and share its result; ``dedup_lines`` drops documents that lose all their lines
with words and keeps every other column; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloss.llm.common import WS, materialize, maybe_broadcast, null_safe, text_or_empty

MIN_WORDS = 8
#: Rows of one or two hashes that may be broadcast.
KEYS_BROADCAST = 400_000


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(line: Column) -> Column:
    """The words of a line, which holds no \\n; most lines have spaces alone, and finding or splitting at one character needs no regex."""
    others = functools.reduce(lambda a, b: a | b, [F.contains(line, F.lit(c)) for c in WS if c not in " \n"])
    spaced = F.when(others, F.translate(line, WS, " " * len(WS))).otherwise(line)
    return F.array_remove(F.split(spaced, " "), "")


def _has_word(line: Column) -> Column:
    return F.ltrim(line, F.lit(WS)) != ""


def _blocks(words: Column, rate: Column) -> Column:
    """Hashes of a line's blocks: marks after the cut words, then one split at the marks; each block begins with a space.

    At rate 1 every word is a block, which needs neither marks nor a split.
    """
    cut = lambda mask: F.transform(words, lambda w: F.when(F.xxhash64(w).bitwiseAND(mask) == 0, F.concat(w, F.lit("\n"))).otherwise(w))
    marked = F.concat(F.lit(" "), F.array_join(bind(rate - 1, cut), " "))
    blocks = F.transform(F.array_remove(F.split(marked, "\n"), ""), lambda b: F.xxhash64(b))
    return F.when(rate == 1, F.transform(words, lambda w: F.xxhash64(w))).otherwise(blocks)


def _block_keys(words: Column, rate: Column, finer: Callable[[], Column] | None = None) -> Column:
    """Keys of a line's block deletions at a cut rate of one in ``rate`` words, a power of two.

    Only if one of two lines within the bound is a single block can nothing of them be
    left, and the other has two blocks at most: such lines give the keys of ``finer`` too.
    """
    none = F.array().cast("array<bigint>")

    def keys(b: Column, whole: Column) -> Column:
        # a block or two neighbours taken out of the exclusive or of all
        one = F.when(F.size(b) > 1, F.transform(b, lambda x: whole.bitwiseXOR(x))).otherwise(none)
        two = F.when((rate > 1) & (F.size(b) > 2), F.zip_with(
            F.slice(one, 1, F.size(b) - 1), F.slice(b, 2, F.size(b) - 1), lambda x, y: x.bitwiseXOR(y))).otherwise(none)
        more = F.when(F.size(b) <= 2, finer()).otherwise(none) if finer else none
        return F.concat(F.array(whole), one, two, more)

    def salted(b: Column) -> Column:
        return F.aggregate(b, F.xxhash64(rate), lambda x, y: x.bitwiseXOR(y))

    return bind(_blocks(words, rate), lambda b: bind(salted(b), lambda w: keys(b, w)))


def _line_keys(words: Column) -> Column:
    """Block keys of a line; for a length at a border those of both rates."""
    none = F.array().cast("array<bigint>")

    def keys(words: Column, n: Column, step: Column) -> Column:
        rate = F.when(step < 0, 1).otherwise(F.pow(F.lit(2), step + 2)).cast("bigint")
        lower = F.when(step <= 0, 1).otherwise(F.pow(F.lit(2), step + 1)).cast("bigint")
        border = n <= 16 * F.pow(F.lit(2), step) + 1
        rates = F.when((step >= 0) & border, F.array(rate, lower)).otherwise(F.array(rate))
        finest = lambda: _block_keys(words, F.lit(1).cast("bigint"))
        middle = lambda r: bind(F.greatest(F.floor(r / 4), F.lit(1)).cast("bigint"), lambda x: _block_keys(words, x, finest))
        levels = F.transform(rates, lambda r: _block_keys(words, r, lambda: middle(r)))
        return F.when(n >= MIN_WORDS - 1, F.flatten(levels)).otherwise(none)

    step = lambda n: F.greatest(F.floor(F.log2(n / 16.0)), F.lit(-1)).cast("int")  # noqa: E731  -1: up to 15 words
    return bind(words, lambda w: bind(F.size(w), lambda n: bind(step(n), lambda s: keys(w, n, s))))


def _lines(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, dh, pos, line, h1, h2) of the lines with a word."""
    text = text_or_empty()
    rows = docs.select("doc_id", F.xxhash64(text).alias("dh"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    return rows.where(_has_word(F.col("line"))).withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(9), "line")})


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "dh", "pos")


def _within_one(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one word edit apart."""
    differ = F.coalesce(F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False), F.lit(0)).cast("int")
    rest = lambda x, i: F.slice(x, i, F.greatest(F.size(x), F.lit(1)))

    def check(i: Column) -> Column:  # the first difference, from 1; 0 if there is none
        return (i == 0) | (rest(a, i + 1) == rest(b, i + 1)) | (rest(a, i) == rest(b, i + 1)) | (rest(a, i + 1) == rest(b, i))

    return bind(differ, lambda i: F.when(i == 0, True).otherwise(check(F.greatest(i, F.lit(1)))))


def _word_variants(cand: DataFrame) -> DataFrame:
    """Rows (key, full, r): each line's variants without one word, and itself."""
    words_in_order = Window.partitionBy("r").orderBy("j")  # one order for both frames: one sort
    line = words_in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = words_in_order.rowsBetween(Window.unboundedPreceding, 0)
    words = cand.select("r", F.size("words").alias("n"), F.posexplode("words").alias("j", "w"))
    words = words.withColumns({"m": F.xxhash64("j", "w"), "s": F.xxhash64(F.col("j") - 1, "w")}).drop("w")
    sums = words.select(
        "r", "j", "m", "n", F.bit_xor("m").over(line).alias("all_m"), F.bit_xor("s").over(line).alias("all_s"),
        F.bit_xor("m").over(upto).alias("upto_m"), F.bit_xor("s").over(upto).alias("upto_s"),
    )
    xor = lambda *c: F.col(c[0]).bitwiseXOR(xor(*c[1:])) if len(c) > 1 else F.col(c[0])
    replaced = F.struct(F.xxhash64(F.lit(1), "n", "j", xor("all_m", "m")).alias("key"), F.lit(None).cast("boolean").alias("full"))
    deleted = F.struct(F.xxhash64(F.lit(2), F.col("n") - 1, xor("upto_m", "m", "all_s", "upto_s")).alias("key"), F.lit(False).alias("full"))
    whole = F.when(F.col("j") == 0, F.struct(F.xxhash64(F.lit(2), "n", "all_m").alias("key"), F.lit(True).alias("full")))
    return sums.select("r", F.explode(F.array_compact(F.array(replaced, deleted, whole))).alias("v")).select("v.key", "v.full", "r")


def kept_lines(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, dh, kept): positions of the lines with words that stay, for documents with any; dh is the text's hash."""
    lines = _lines(docs).select(_place().alias("place"), "h1", "h2", _line_keys(_words(F.col("line"))).alias("keys"))
    distinct = materialize(lines.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.any_value("keys").alias("keys")), "lines")

    keys = distinct.select("h1", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b").select("key")
    shared = materialize(shared, "shared")
    partners = materialize(keys.join(maybe_broadcast(shared, KEYS_BROADCAST), "key", "left_semi").select("h1").distinct(), "partners")

    # r grows with the place: range partitions in order, rows in order, written once
    wanted = distinct.select("h1", "h2", "place").join(maybe_broadcast(partners, KEYS_BROADCAST), "h1", "left_semi")
    wanted = wanted.repartitionByRange("place").sortWithinPartitions("place").withColumn("r", F.monotonically_increasing_id())
    wanted = materialize(wanted, "wanted")
    text = text_or_empty()
    found = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("dh"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    wanted = wanted.select("h1", "h2", "r", "place.*")
    found = found.join(maybe_broadcast(wanted), ["dh", "pos"]).where(F.col("id").eqNullSafe(F.col("doc_id")))
    cand = materialize(found.select("h1", "h2", "r", _words(F.col("line")).alias("words")).dropDuplicates(["r"]), "candidates")

    variants = materialize(_word_variants(cand), "variants")
    part = F.col("full").isNull() | ~F.col("full")
    firsts = variants.groupBy("key").agg(
        F.count("*").alias("n"), F.min(F.when(F.col("full"), F.col("r"))).alias("full_r"), F.min(F.when(part, F.col("r"))).alias("part_r"))
    firsts = materialize(firsts.where("n > 1").drop("n"), "firsts")
    earlier = F.when(F.col("full").isNull() | F.col("full"), F.col("part_r")).otherwise(F.col("full_r"))
    links = variants.join(maybe_broadcast(firsts), "key").withColumn("earlier", earlier).where("earlier < r")
    links = links.groupBy("r").agg(F.min("earlier").alias("earlier"))
    both = links.join(cand.where(F.size("words") >= MIN_WORDS), "r").join(cand.select(F.col("r").alias("earlier"), F.col("words").alias("others")), "earlier")
    gone = materialize(both.where(_within_one(F.col("words"), F.col("others"))).select("h1", "h2"), "gone")

    stay = distinct.select("h1", "h2", "place").join(maybe_broadcast(gone, KEYS_BROADCAST), ["h1", "h2"], "left_anti")
    return stay.groupBy("place.doc_id", "place.dh").agg(F.sort_array(F.collect_list("place.pos")).alias("kept"))


def line_report(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_lines, n_kept, kept): lines with a word, and the positions of those that stay."""
    kept = materialize(kept_lines(docs), "kept")
    text = text_or_empty()
    counts = docs.select("doc_id", F.xxhash64(text).alias("dh"), F.size(F.filter(F.split(text, "\n"), _has_word)).alias("n_lines"))
    joined = null_safe(counts, kept, ["doc_id", "dh"], "left")
    kept_or_none = F.coalesce("kept", F.array().cast("array<int>"))
    return joined.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size(kept_or_none).cast("long").alias("n_kept"), kept_or_none.alias("kept"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without the lines that go; documents that lose all their lines with words are dropped."""
    kept = materialize(kept_lines(docs), "kept")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", F.xxhash64(text_or_empty()).alias("dh"))
    joined = null_safe(keyed, kept, ["doc_id", "dh"], "left")

    def rebuilt(lines: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        worded = F.filter(every, lambda i: F.get(lines, i).rlike(r"[^\x20\x09-\x0D]"))
        gone = F.array_except(worded, F.coalesce("kept", F.array().cast("array<int>")))
        return F.array_join(F.transform(F.array_except(every, gone), lambda i: F.get(lines, i)), "\n")

    text = F.col("_row.text")
    had_words = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    out = joined.where(F.col("kept").isNotNull() | ~had_words)
    new = F.when(F.col("kept").isNull(), text).otherwise(bind(F.split(text, "\n"), rebuilt))
    columns = [new.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns]
    return out.select(*columns)
