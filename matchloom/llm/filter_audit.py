"""How five text filters act together: inclusion-exclusion over the 32 sets of filters.

For each part and each set S of filters, J(S) counts the documents that fail all of S: the sum of the product of the filters' 0/1 flags.
Everything else is arithmetic on these 32 numbers (Moebius inversion over subsets):

    kept after the filters of P       sum over S in P of (-1)^|S| J(S)
    failing f and no other            sum over S with f of (-1)^(|S|-1) J(S)
    Shapley value of f, times 120     sum over S with f of d(S) * 120 / |S|, where d(S) = (-1)^(|S|+1) J(S) is the Harsanyi dividend
                                      of the game "documents that at least one filter of the set removes"

J is also taken over the documents that labels call good, and over those they call toxic.

Filters (a document fails if): A it has under 200 words; B distinct words are under half of its words; C over 2 % of its characters are A-Z;
D it holds any of #$%&*|; E its text is that of a smaller doc_id anywhere in the table.

Rows: a null text is empty (no words, so it fails A, and E if a smaller id is empty too). A null doc_id is smaller than none and larger than
none: such a row neither fails E nor makes another fail. Repeated rows count each; rows of one id and one text don't fail E by one another.
A document with several label rows is good (toxic) if any of them says so. A null source is the part ''. An empty table gives no rows.
Texts are held equal by SHA-256. Other columns are never read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

FILTERS = "ABCDE"
FULL = (1 << len(FILTERS)) - 1
WHO = ("all", "good", "toxic")
SPLIT = r"[\x20\x09-\x0D]+"


def flagged(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text and the flags A to D, each 1 where the document fails. The text is cut into words once."""
    text = F.coalesce("text", F.lit(""))
    cut = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("t"), F.split(text, SPLIT).alias("w"))
    # only the first and the last piece can be empty
    empty = F.when(F.col("w")[0] == "", 1).otherwise(0) + F.when((F.size("w") > 1) & (F.element_at("w", -1) == ""), 1).otherwise(0)
    words, distinct = F.size("w") - empty, F.size(F.array_distinct("w")) - F.when(empty > 0, 1).otherwise(0)
    flag = lambda c: c.cast("long")
    return cut.select(
        "doc_id", "part", F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"), flag(words < 200).alias("A"), flag(100 * distinct < 50 * words).alias("B"),
        flag(100 * F.length(F.regexp_replace("t", "[^A-Z]+", "")) > 2 * F.length("t")).alias("C"), flag(F.col("t").rlike("[#$%&*|]")).alias("D"),
    )


def failures(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """part, A to E, good, toxic: a row for each document.

    The flags are written, a row of some 80 bytes for each text, and read twice. E takes no join on the digest alone, which a third of all
    rows may share: the least id of each digest is aggregated (combined before the shuffle), and a row is that first one where digest and id are equal."""
    rows = scratch.table(flagged(docs), "flags")
    least = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(1))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    # rows without an id join nothing: they are dealt over all tasks by their digest
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(4096))).otherwise(F.lit(0)).cast("long")
    found = rows.withColumn("spread", spread).join(known.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left").join(least, ["digest", "doc_id"], "left")
    late = (F.col("doc_id").isNotNull() & F.col("first").isNull()).cast("long")
    return found.select("part", *"ABCD", late.alias("E"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def _product(mask: int) -> Column:
    out = F.lit(1).cast("long")
    for i, f in enumerate(FILTERS):
        out = out * F.col(f) if mask >> i & 1 else out
    return out


def joint_failures(failed: DataFrame) -> DataFrame:
    """part, all_S, good_S, toxic_S for each of the 32 sets S (as a bit mask, A lowest): sums of products of flags."""
    weights = {"all": F.lit(1).cast("long"), "good": F.col("good"), "toxic": F.col("toxic")}
    return failed.groupBy("part").agg(*[F.sum(_product(s) * weights[who]).alias(f"{who}_{s}") for who in WHO for s in range(FULL + 1)])


def _signed(who: str, sets: list[int], scale=lambda size: 1, flip: int = 0) -> Column:
    out = F.lit(0).cast("long")
    for s in sets:
        out = out + F.col(f"{who}_{s}") * F.lit((-1) ** (s.bit_count() + flip) * scale(s.bit_count()))
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the five filters and step; see the module for the columns' formulas."""
    joint = joint_failures(failures(docs, labels, Scratch(docs.sparkSession, "filter-audit")))
    subsets = lambda p: [s for s in range(FULL + 1) if s & p == s]
    having = lambda i: [s for s in range(FULL + 1) if s >> i & 1]
    each = range(len(FILTERS))
    inverted = joint.select(
        "part",
        *[F.array(*[_signed(who, subsets(p)) for p in range(FULL + 1)]).alias(who) for who in WHO],
        F.array(*[F.col(f"all_{1 << i}") for i in each]).alias("fails"),
        F.array(*[_signed("all", having(i), flip=1) for i in each]).alias("alone"),
        F.array(*[_signed("all", having(i), lambda size: 120 // size, flip=1) for i in each]).alias("dividends"),
    )
    orders = F.split(F.lit(",".join(map("".join, permutations(FILTERS)))), ",")
    steps = inverted.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    before = F.expr("substring(filter_order, 1, step - 1)")
    mask = sum((F.when(F.contains(F.col("before"), F.lit(f)), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))
    at = F.expr(f"instr('{FILTERS}', substring(filter_order, step, 1))") - 1
    placed = steps.withColumn("before", before).withColumn("done", mask).withColumn("at", at).withColumn("now", F.expr("done + shiftleft(1, at)"))
    kept = lambda who, col: F.get(F.col(who), F.col(col))
    lost = lambda who: kept(who, "done") - kept(who, "now")
    of = lambda name: F.get(F.col(name), F.col("at"))
    return placed.select(
        "part", "filter_order", "step", kept("all", "now").alias("kept"), lost("all").alias("removed"), (of("fails") - lost("all")).alias("redundant"),
        of("alone").alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), of("dividends").alias("shapley"),
    )
