"""Dedup of repeated passages: of every run of whole units of over LEAST words that occurs again, only the first place stays.

A text's units are its lines, which are also cut after sentence ends (PATTERN), so that a passage within one long line is found. Each unit is hashed.
A chunk is the shortest run of units from a unit on, or back from it, with over LEAST words. Its ends depend on its own units alone, so they
don't shift with what stands beside it, and a rolling hash over its unit hashes stands for it. (Chunks between boundaries that a hash chooses, see line_chunks,
find only what fills a whole chunk; a passage of one to six lines mostly fills none.) Equal runs of over LEAST words hold equal
chunks, which cover them from the first unit to the last. So no extension and no sampling is needed: the result is all runs.

Chunks are equal if the units are, but for white space at a unit's ends, as held by two hashes of 64 bits over the digests of 128 bits of the units' bytes: a run that differs goes
only if both hashes or a whole digest collide. (The bytes themselves aren't compared: that needs a second shuffle of all texts.) They are shuffled once as hashes and places, and a chunk keeps its first place: least id (null counts as the largest), then text hash, then unit. Later chunks
go, but not those in the same document that overlap the first one, so one copy of a repeating line stays whole. A removed unit has an equal one at an earlier
place, and following these ends at one that stays. Rows equal in id and text are one document and stay alike.

Chunks of one passage are one key. The most frequent keys in the documents with one hash of SHARE (HOT at most, which only deals out work and decides nothing) are dealt to
SALTS tasks each; what is left as first in those meets once more, at most a few rows for each of them. So no task grows with a common passage.

What it can't see: a passage that starts or ends within a unit counts only with its whole units. A null text stays null; extra columns are kept.
All is in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, fresh

LEAST = 50
SALTS, SHARE, HOT = 64, 128, 4096
SEGMENT, SEED, DIGEST = 1000, 7919, 16
#: A cut stands behind a line break or a space; that is asked first, as most places fail it.
PATTERN = r"(?<=[\n ])(?:(?<=\n)(?=[^\S\n]*+\S)|(?<=[.!?;:|] )(?=\S))"
BLANK = " \t\r\n\x0b\x0c"


def unit_digest(u: Column) -> Column:
    """128 bits of a unit's bytes, as DIGEST bytes in hexadecimal digits."""
    return F.md5(u)


def units(text: Column) -> Column:
    """The pieces of a text, each with the white space after it; joined they are the text."""
    return F.split(text, PATTERN, -1)


def _trim(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANK))


def _uneven(text: Column) -> Column:
    """Whether other than single spaces may stand between two words of a unit. A unit's line breaks are at its end."""
    found = F.contains(text, F.lit("  "))
    for c in "\t\r\x0b\x0c":
        found = found | F.contains(text, F.lit(c))
    return found


def _spaced(u: Column) -> Column:
    """Number of words of a trimmed unit with single spaces between them."""
    return F.when(u == "", 0).otherwise(F.octet_length(u) - F.octet_length(F.replace(u, F.lit(" "), F.lit(""))) + 1)


def _words(u: Column) -> Column:
    """Number of words of any trimmed unit."""
    return F.when(_uneven(u), F.regexp_count(u, F.lit(r"\S+"))).otherwise(_spaced(u))


def _packed(start: Column, end: Column) -> Column:
    return start.cast("long") * 2**32 + end


def _start(s: Column) -> Column:
    return F.shiftright(s, 32).cast("int")


def _end(s: Column) -> Column:
    return s.bitwiseAND(F.lit(2**32 - 1)).cast("int")


def _chunks(docs: DataFrame, least: int, segment: int = SEGMENT) -> DataFrame:
    """(_id, _hash, s, h, g): every shortest run of units of over `least` words, forward and backward, as packed place and hashes.

    A text's units are taken in segments, so that no row grows with the text: each holds `segment` units, whose runs start (forward) or end (backward) there, and `least` more on either
    side, as every unit has a word. A unit counts as `least` + 1 words at most: it is a run by itself then."""
    text = F.coalesce("_text", F.lit(""))
    cut = docs.select("_id", "_hash", _uneven(text).alias("uneven"), F.transform(units(text), _trim).alias("u"))
    counted = lambda words: F.transform("u", lambda u: F.struct(unit_digest(u).alias("d"), words(u).alias("n")))
    cut = cut.select("_id", "_hash", F.when(F.col("uneven"), counted(_words)).otherwise(counted(_spaced)).alias("u"))
    cut = cut.select("_id", "_hash", F.col("u.d").alias("u"), F.col("u.n").alias("n"))
    at = F.when(F.size("u") > segment, F.sequence(F.lit(0), F.size("u") - 1, F.lit(segment))).otherwise(F.array(F.lit(0)))
    # the segments are cut out before they are exploded: exploded places would each carry the whole text's units
    piece = lambda c, lo, a: F.when(F.col("long"), F.slice(c, lo + 1, a - lo + segment + least)).otherwise(F.col(c)).alias(c)
    low = lambda a: F.greatest(a - least, F.lit(0))
    cut = cut.select("_id", "_hash", "u", "n", (F.size("u") > segment).alias("long"), at.alias("at"))
    cut = cut.select("_id", "_hash", "long", F.explode_outer(F.transform("at", lambda a: F.struct(low(a).alias("lo"), (a - low(a)).alias("a"), piece("u", low(a), a), piece("n", low(a), a)))).alias("p"))
    cut = cut.select("_id", "_hash", "long", "p.lo", "p.a", "p.u", "p.n")
    # twice the unit of each word, and one more for a unit's first word; only a text's first unit can be blank
    several = lambda n, i: F.concat(F.array(2 * i + 1), F.array_repeat(2 * i, F.least(n, F.lit(least + 1)) - 1))
    cut = cut.select("_id", "_hash", "long", "lo", "a", "u", F.flatten(F.transform("n", lambda n, i: F.when(n > 0, several(n, i)).otherwise(F.array().cast("array<int>")))).alias("of"))

    def unit(k: Column) -> Column:
        return F.shiftright(F.get(F.col("of"), k), 1)

    def owned(places: Column) -> Column:
        """Of a long text's segment those places that are its own; others are a neighbour's."""
        return F.when(F.col("long"), F.filter(places, lambda k: (unit(k) >= F.col("a")) & (unit(k) < F.col("a") + segment))).otherwise(places)

    words = F.size("of")
    starts = F.array_compact(F.transform("of", lambda x, k: F.when(x.bitwiseAND(F.lit(1)) == 1, k)))
    cut = cut.select("_id", "_hash", "long", "lo", "a", "u", "of", F.when(words > least, starts).alias("k"))
    first = F.transform(owned(F.filter("k", lambda k: k + least < words)), lambda k: _packed(unit(k), unit(k + least)))
    ends = F.concat(F.transform("k", lambda k: k - 1), F.array(words - 1))
    last = F.transform(owned(F.filter(ends, lambda k: k >= least)), lambda k: _packed(unit(k - least), unit(k)))
    cut = cut.select("_id", "_hash", "lo", "u", F.array_union(first, last).alias("s"))
    # a run's digests are a stretch of all digests' bytes: one cut, where a list of its units would be built of single ones
    cut = cut.select("_id", "_hash", "lo", "s", F.when(F.size("s") > 0, F.unhex(F.array_join("u", ""))).alias("d"))
    own = lambda s: F.substring("d", _start(s) * DIGEST + 1, (_end(s) - _start(s) + 1) * DIGEST)
    run = F.transform("s", lambda s: F.struct(s.alias("s"), own(s).alias("d")))
    hashed = F.transform(run, lambda r: F.struct(r.s.alias("s"), F.xxhash64(r.d).alias("h"), F.xxhash64(F.lit(SEED), r.d).alias("g")))
    each = cut.select("_id", "_hash", "lo", F.explode(hashed).alias("c"))
    return each.select("_id", "_hash", (F.col("c.s") + F.col("lo").cast("long") * F.lit(2**32 + 1)).alias("s"), "c.h", "c.g")


def _hot(docs: DataFrame, least: int) -> DataFrame:
    """(_hot): hashes of the most frequent chunks, HOT at most, from a share of the documents. They only deal out work."""
    some = docs.where(F.pmod("_hash", F.lit(SHARE)) == 0)
    found = _chunks(some, least).groupBy("h").agg(F.count("*").alias("n")).where("n >= 8").orderBy(F.col("n").desc(), "h").limit(HOT).select("h").collect()
    return docs.sparkSession.createDataFrame([(r.h,) for r in found], "_hot long")


def _later(f: str) -> Column:
    """Whether a chunk goes, given its key's first place: that is in another document, or before it and apart from it."""
    same = F.col(f"{f}._id").eqNullSafe(F.col("_id")) & (F.col(f"{f}._hash") == F.col("_hash"))
    return ~same | (_start(F.col("s")) > _end(F.col(f"{f}.s")))


def _removals(docs: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """(_id, _hash, _gone): the units of a document that go. docs: _id, _hash, _text."""
    order = [F.col("_id").asc_nulls_last(), F.col("_hash"), F.col("s")]
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64("_id", "_hash"), F.lit(SALTS)).cast("int"))
    dealt = _chunks(docs, least).join(F.broadcast(_hot(docs, least)), F.col("h") == F.col("_hot"), "left").select("_id", "_hash", "s", "h", "g", salt.alias("salt"))
    by = Window.partitionBy("h", "g", "salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("f", F.first(F.struct("_id", "_hash", "s")).over(by))
    marked = placed.select("_id", "_hash", "s", "h", "g", (~_later("f")).alias("open"), F.col("salt").isNotNull().alias("hot")).where("hot or not open")
    marked = scratch.table(marked, "chunks")
    again = Window.partitionBy("h", "g").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = marked.where("open").withColumn("f", F.first(F.struct("_id", "_hash", "s")).over(again)).where(_later("f"))
    gone = marked.where("not open").select("_id", "_hash", "s").union(left.select("_id", "_hash", "s"))
    # chunks that overlap or touch become one stretch, so that a document's list is no longer than its units
    before = Window.partitionBy("_id", "_hash").orderBy("s")
    stretch = gone.select("_id", "_hash", "s", F.max(_end(F.col("s"))).over(before.rowsBetween(Window.unboundedPreceding, -1)).alias("reached"))
    apart = F.coalesce(_start(F.col("s")) > F.col("reached") + 1, F.lit(True)).cast("int")
    stretch = stretch.withColumn("k", F.sum(apart).over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    stretch = stretch.groupBy("_id", "_hash", "k").agg(F.min(_start(F.col("s"))).alias("a"), F.max(_end(F.col("s"))).alias("b"))
    lists = stretch.groupBy("_id", "_hash").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("s"))
    return lists.select("_id", "_hash", F.flatten(F.transform("s", lambda x: F.sequence(x.a, x.b))).alias("_gone"))


def _rest(own: Column, gone: Column) -> Column:
    """The text of the units that stay. A line break among removed units stays where the text before them has none, so that no two lines are joined."""

    def joined(u: Column, rest: Column) -> Column:
        def piece(a: Column, r: Column) -> Column:
            here, after = F.get(u, a), F.get(rest, (r + 1).cast("int"))
            breaks = lambda: F.exists(F.sequence(a + 1, after - 1), lambda k: F.contains(F.get(u, k), F.lit("\n")))
            cut = F.when(after > a + 1, ~F.contains(here, F.lit("\n")) & breaks()).otherwise(False)
            return F.when(after.isNull() & (a < F.size(u) - 1), F.rtrim(here, F.lit(BLANK))).when(cut, F.concat(F.rtrim(here, F.lit(BLANK)), F.lit("\n"))).otherwise(here)

        return F.array_join(F.transform(rest, piece), "")

    keep = lambda u: F.array_except(F.sequence(F.lit(0), F.size(u) - 1), gone)
    one = F.transform(F.array(own), lambda u: F.get(F.transform(F.array(keep(u)), lambda rest: joined(u, rest)), F.lit(0)))
    return F.get(one, F.lit(0))


def without_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", report: bool = False, least: int = LEAST) -> DataFrame:
    """The documents with all their columns and the text without repeated passages; report adds removed_units."""
    own_id, own_hash = fresh(docs, "own_id"), fresh(docs, "own_hash")
    keyed = docs.withColumn(own_id, F.col(id_col).cast("long")).withColumn(own_hash, F.xxhash64(F.col(text_col).cast("string")))
    gone = _removals(keyed.select(F.col(own_id).alias("_id"), F.col(own_hash).alias("_hash"), F.col(text_col).cast("string").alias("_text")), least, Scratch(docs.sparkSession, "passages"))
    names = {c: fresh(docs, c) for c in ("gone_id", "gone_hash", "gone_units")}
    gone = gone.toDF(*names.values())
    both = keyed.join(gone.hint("shuffle_hash"), F.col(own_id).eqNullSafe(F.col(names["gone_id"])) & (F.col(own_hash) == F.col(names["gone_hash"])), "left")
    plain = F.col(text_col).cast("string")
    text = F.when(F.col(names["gone_units"]).isNull(), plain).otherwise(_rest(units(plain), F.col(names["gone_units"])))
    columns = [text.alias(c) if c.lower() == text_col.lower() else F.col(c) for c in docs.columns]
    if report:
        columns += [F.coalesce(F.size(names["gone_units"]), F.lit(0)).cast("long").alias("removed_units")]
    return both.select(*columns)
