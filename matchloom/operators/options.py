"""Option texts: dictionaries of terms, a short one as an expression over literals a longer one as an automaton in the tasks, one of any size by joins, and risk flags."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from matchloom.functions.text import compact, like_any
from matchloom.session import working_folder


def dictionary_term(text: Column, terms: list[tuple[str, str, str]], pinned: str | None = None) -> Column:
    """Struct (category, term) of the longest term that the text has, null without one. terms: (category, term, contains or token).

    The pinned category wins over length; ties go to the term that sorts first. A token must stand alone between other signs; a contained term is
    looked for in the letters and digits alone. The dictionary is part of the expression, so nothing is joined."""
    flat, spaced = compact(text), F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    order = sorted(terms, key=lambda t: (t[0] != pinned, -len(t[1]), t[1]))
    hits = [F.when(F.contains(spaced, F.lit(f" {term} ")) if mode == "token" else F.contains(flat, F.lit(term)), F.struct(F.lit(category).alias("category"), F.lit(term).alias("term"))) for category, term, mode in order]
    return F.coalesce(*hits)


#: Characters of a contained term that are looked up, of those the start that is asked for first, and how many entries a broadcast table of either may have.
GRAM, HEAD, FEW = 8, 4, 65_536
#: Characters of a text that are cut into pieces at once.
STRETCH = 256


def _order(pinned: str | None) -> Column:
    """What of several terms wins, least first."""
    other = F.coalesce(F.col("category") != pinned, F.lit(True)) if pinned is not None else F.lit(True)
    return F.struct(other.alias("other"), (-F.length("term")).alias("short"), F.col("term"), F.col("category"), F.col("mode"))


def dictionary_terms(rows: DataFrame, text: str, terms: DataFrame, pinned: str | None = None, block_bytes: int = 16_000_000) -> DataFrame:
    """Adds category and term as dictionary_term finds them, for a dictionary of any size. terms: category, term, mode (contains or token); blanks are none.

    A dictionary of up to block_bytes (64 more for each term) is broadcast and searched for as one automaton in every task. A larger one is joined: no task, worker or driver holds it, and
    the work grows with the texts and the terms each, not with both together (see _by_join). Of equal terms the lesser category wins."""
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    shaped = rows.select("*", compact(F.col(text)).alias("_flat"), spaced.alias("_spaced"))
    known = terms.select("category", "term", "mode").where("term is not null and term != ''").distinct()
    size = known.agg(F.sum(F.length("term") + 64)).first()[0] or 0
    out = _by_automaton(shaped, known, pinned) if size <= block_bytes else _by_join(shaped, known, pinned)
    return out.select(*rows.columns, "category", "term")


def _by_automaton(shaped: DataFrame, known: DataFrame, pinned: str | None) -> DataFrame:
    """In one pass over the texts without a shuffle."""
    out = shaped.select("*", F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("term"))
    schema = StructType([*shaped.schema.fields, *(StructField(c, StringType()) for c in ("category", "term"))])
    block = [(rank, *r) for rank, r in enumerate(known.orderBy(_order(pinned)).collect())]
    if not block:
        return out
    held = shaped.sparkSession.sparkContext.broadcast(block)

    def found(batches):
        import ahocorasick

        flat, tokens = ahocorasick.Automaton(), ahocorasick.Automaton()
        for rank, category, term, mode in reversed(held.value):  # of equal terms the first stays
            if mode == "token":
                tokens.add_word(f" {term} ", (rank, category, term))
            else:
                flat.add_word(term, (rank, category, term))
        sought = [(a, c) for a, c in ((flat, "_flat"), (tokens, "_spaced")) if len(a)]
        for a, _ in sought:
            a.make_automaton()
        for batch in batches:
            category, term = batch.column("category").to_pylist(), batch.column("term").to_pylist()
            texts = [(a, batch.column(c).to_pylist()) for a, c in sought]
            for i in range(len(term)):
                hits = [v for a, t in texts if t[i] is not None for _, v in a.iter(t[i])]
                if hits:
                    _, category[i], term[i] = min(hits)
            columns = [batch.column(c) for c in batch.schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(category, pa.string()), pa.array(term, pa.string())], schema=batch.schema)

    return out.mapInArrow(found, schema)


def _pieces(text: Column, n: int) -> Column:
    """All stretches of n characters of a text. It is cut into longer stretches first, as a place in a text is found by counting from its start."""
    cut = lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: F.substr(s, i, F.lit(n)))
    long = F.transform(F.sequence(F.lit(1), F.length(text) - n + 1, F.lit(STRETCH)), lambda b: F.substr(text, b, F.lit(STRETCH + n - 1)))
    return F.when(F.length(text) >= n, F.array_distinct(F.flatten(F.transform(long, cut)))).otherwise(F.array().cast("array<string>"))


def _word_runs(spaced: Column, n: int) -> Column:
    """All runs of n words."""
    runs = lambda w: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.flatten(F.transform(F.array(F.split(F.trim(spaced), " ")), runs)))  # bound as the one element of an array, so that it is split once


def _by_join(shaped: DataFrame, known: DataFrame, pinned: str | None) -> DataFrame:
    """By equi-joins: a token term with the texts' runs of as many words; a contained term by its rarest stretch of GRAM characters, or as a whole if it is shorter, with the texts'
    stretches of that length, after which the text is searched for the whole term.

    Equal texts are looked up once. What has no term's first HEAD characters is left out before the shuffle, as long as there are FEW of these. Which stretch is rarest is told from the FEW most
    frequent ones, which are broadcast; that only deals out work."""
    is_token, n = F.coalesce(F.col("mode") == "token", F.lit(False)), F.length("term")
    contained, token = known.where(~is_token), known.where(is_token)
    lengths = known.agg(F.collect_set(F.when(~is_token, F.least(n, F.lit(GRAM)))), F.collect_set(F.when(is_token, F.size(F.split("term", " "))))).first()
    each = contained.where(n >= GRAM).select("category", "term", "mode", F.explode(_pieces(F.col("term"), GRAM)).alias("gram"))
    frequent = each.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.col("n").desc(), "gram").limit(FEW)
    rarest = each.join(F.broadcast(frequent), "gram", "left").groupBy("category", "term", "mode").agg(F.min(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "gram")).alias("g"))
    anchored = rarest.select("category", "term", "mode", F.col("g.gram").alias("gram")).union(contained.where(n < GRAM).select("category", "term", "mode", F.col("term"))).withColumn("kind", F.lit("part"))
    anchored = anchored.union(token.select("category", "term", "mode", "term", F.lit("word")))
    path = working_folder(shaped.sparkSession, "terms")
    anchored.write.parquet(path)  # asked for twice
    anchored = shaped.sparkSession.read.schema(anchored.schema).parquet(path)
    head = F.substring("gram", 1, HEAD).alias("head")
    heads = anchored.select("kind", head).distinct()
    sought = [(_pieces(F.col("_flat"), k), "part") for k in sorted(lengths[0])] + [(_word_runs(F.col("_spaced"), k), "word") for k in sorted(lengths[1])]
    named = lambda kind: lambda g: F.struct(F.lit(kind).alias("kind"), g.alias("gram"))
    grams = F.concat(*(F.transform(a, named(kind)) for a, kind in sought))
    texts = shaped.select("_flat", "_spaced").where("_flat is not null").distinct()
    texts = texts.select("_flat", "_spaced", F.explode(grams).alias("g")).select("_flat", "_spaced", "g.kind", "g.gram")
    if heads.limit(FEW + 1).count() <= FEW:
        texts = texts.withColumn("head", head).join(F.broadcast(heads), ["kind", "head"], "left_semi")
    met = texts.join(anchored, ["kind", "gram"]).where((F.col("kind") == "word") | F.contains("_flat", "term"))
    best = met.groupBy("_flat", "_spaced").agg(F.min(_order(pinned)).alias("_best"))
    return shaped.join(best, ["_flat", "_spaced"], "left").withColumns({"category": F.col("_best.category"), "term": F.col("_best.term")})


def risk_flags(text: Column, words: dict[str, list[str]]) -> dict[str, Column]:
    """A flag for each group of words that the text contains, case ignored; null texts have none."""
    return {k: like_any(F.coalesce(text, F.lit("")), [f"%{w}%" for w in group]) for k, group in words.items()}


def joined_reasons(flags: dict[str, Column]) -> Column:
    """The names of the flags that hold, in their order, comma-joined."""
    return F.array_join(F.filter(F.array(*(F.when(p, F.lit(k)) for k, p in flags.items())), lambda x: x.isNotNull()), ",")
