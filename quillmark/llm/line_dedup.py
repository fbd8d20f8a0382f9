"""Line dedup with a log-template tree, in DataFrame functions only.

Tokens with a digit are variable fields.  The tree has a fixed depth: lines
part by their number of tokens, then by their leading tokens.  In a leaf, a
token that only one different line has at its place, or less than
``FIELD_SHARE`` of the leaf's different lines, becomes a variable field too,
and what remains is the line's template.  Different lines are counted, not
documents, so more copies of a corpus have the same templates.  With ``near`` a
line also falls to a line of its leaf that more documents hold (the heaviest of
those with which it agrees in a quarter of its places) if they agree in
``CONSTANT_SHARE`` of its tokens without digits.  Lines that recur in
``min_docs`` documents or more, as they stand or by their template, are dropped,
except in the first of these documents (by doc_id), which keeps its first such
line.

Lines travel as two 64-bit hashes and a few numbers.  Only lines in leaves that
hold different lines are looked up again for their tokens, one copy of each.

Lines with fewer than ``LEAST_TOKENS`` tokens or ``LEAST_CONSTANTS`` fixed ones
have no template; with ``short`` they go where they recur exactly, digits too.

Edge cases: null texts stay null, empty ones empty; blank lines are never dropped;
rows that repeat another row (doc_id and text) get the same decision; rows
without a doc_id come first in the order; extra columns pass through whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Documents in which a template recurs.
MIN_DOCS = 2
#: Leading tokens of the tree.
DEPTH = 4
LEAST_TOKENS = 3
LEAST_CONSTANTS = 2
#: Different lines, and share of a leaf's different lines, that fix a token at its place.
FIXED_LINES, FIELD_SHARE = 2, 0.05
#: Share of the tokens without digits that a template must keep.
CONSTANT_SHARE = 0.7
#: Stretches of a line, one of which agrees with the line that it falls to.
STRETCHES = 4
#: Lines to look up again that are broadcast at most (about 60 bytes each).
BROADCAST_ROWS = 300_000

_LINE = ["h1", "h2", "leaf", "tokens", "constants"]

#: A token with a digit; it can only begin where a token begins.
_VARIABLE = "(?<![^\\\\x20\\\\x09-\\\\x0D])[^\\\\x20\\\\x09-\\\\x0D0-9]*+[0-9][^\\\\x20\\\\x09-\\\\x0D]*+"
_MASKED = f"if(text rlike '[0-9]', regexp_replace(text, '{_VARIABLE}', '<*>'), text)"
_UNEVEN = " or ".join(f"contains(masked, '{c}')" for c in ("  ", "\t", "\x0b", "\x0c", "\r"))
_SPACED = f"if({_UNEVEN}, regexp_replace(masked, '[\\\\x20\\\\x09\\\\x0B-\\\\x0D]+', ' '), masked)"
_TOKENS = "(octet_length(line) - octet_length(replace(line, ' ', '')) + if(line = '', 0, 1))"
_CONSTANTS = f"({_TOKENS} - if(contains(line, '<*>'), size(filter(split(line, ' '), t -> t = '<*>')), 0))"


def _lines(docs: DataFrame) -> DataFrame:
    """k1, k2, at, line (tokens with single spaces, variable fields masked) of
    all lines.  Whole texts are masked before they are cut."""
    masked = docs.where("text is not null").select("k1", "k2", F.expr(_MASKED).alias("masked")).select("k1", "k2", F.expr(_SPACED).alias("spaced"))
    return masked.select("k1", "k2", F.posexplode(F.split("spaced", "\n")).alias("at", "line")).withColumn("line", F.trim("line"))


def _keyed(docs: DataFrame) -> DataFrame:
    k1, k2 = common.row_key(docs)
    return docs.select(k1.alias("k1"), k2.alias("k2"), "text")


def line_hashes(docs: DataFrame) -> DataFrame:
    """k1, k2, at and hashes and counts of all lines."""
    return _lines(_keyed(docs)).selectExpr(
        "k1", "k2", "at", "xxhash64(line) as h1", "xxhash64(1, line) as h2",
        f"xxhash64({_TOKENS}, substring_index(line, ' ', {DEPTH})) as leaf", f"{_TOKENS} as tokens", f"{_CONSTANTS} as constants",
    )


def short_lines(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """k1, k2, at, h1, h2 of the lines that are too short for a template.
    Those with variable fields are hashed as they stand."""
    few = f"tokens > 0 and (tokens < {LEAST_TOKENS} or constants < {LEAST_CONSTANTS})"
    plain = hashes.where(f"{few} and constants = tokens").select("k1", "k2", "at", "h1", "h2")
    wanted = common.stored(hashes.where(f"{few} and constants < tokens").select("k1", "k2", "at"), "lines-marked")
    holders = wanted.select("k1", "k2").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        wanted, holders = F.broadcast(wanted), F.broadcast(holders)
    raw = _keyed(docs).join(holders, ["k1", "k2"], "left_semi").select("k1", "k2", F.posexplode(F.split("text", "\n")).alias("at", "text")).join(wanted, ["k1", "k2", "at"], "left_semi")
    raw = raw.selectExpr("k1", "k2", "at", "trim(regexp_replace(text, '[\\x20\\x09\\x0B-\\x0D]+', ' ')) as raw")
    return plain.unionByName(raw.selectExpr("k1", "k2", "at", "xxhash64(2, raw) as h1", "xxhash64(3, raw) as h2"))


def templates(docs: DataFrame, hashes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Different lines (kinds); those of leaves that hold several, with the
    template that they have if any (shapes); and the latter's tokens."""
    once = hashes.groupBy("k1", "k2", *_LINE).agg(F.lit(1).alias("one"))
    kinds = common.stored(once.groupBy(*_LINE).agg(F.count("*").alias("docs"), F.min(F.struct("k1", "k2")).alias("first")), "lines-kinds")
    leaves = kinds.groupBy("leaf").agg(F.count("*").alias("different")).where("different > 1")
    mixed = common.stored(kinds.join(leaves, "leaf"), "lines-mixed")

    # tokens of the lines in leaves with different lines, from their first documents
    wanted = mixed.select("h1", "h2", "leaf", F.col("first.k1").alias("k1"), F.col("first.k2").alias("k2"), "docs", "different", F.col("tokens").alias("n"))
    holders = wanted.select("k1", "k2").distinct()
    if mixed.count() <= BROADCAST_ROWS:
        wanted, holders = F.broadcast(wanted), F.broadcast(holders)
    found = _lines(_keyed(docs).join(holders, ["k1", "k2"], "left_semi")).selectExpr("k1", "k2", "xxhash64(line) as h1", "xxhash64(1, line) as h2", "line")
    found = found.join(wanted, ["k1", "k2", "h1", "h2"]).groupBy("h1", "h2", "leaf", "docs", "different", "n").agg(F.any_value("line").alias("line"))
    tokens = common.stored(found.select("h1", "h2", "leaf", "docs", "different", "n", F.posexplode(F.split("line", " ")).alias("place", "token")), "lines-tokens")
    support = tokens.groupBy("leaf", "place", "token").agg(F.count("*").alias("lines"), F.any_value("different").alias("of")).where(f"lines >= {FIXED_LINES} and lines >= {FIELD_SHARE} * of")
    fixed = tokens.join(support.hint("shuffle_hash"), ["leaf", "place", "token"]).select("h1", "h2", F.xxhash64("place", "token").alias("part"), (F.col("token") != "<*>").cast("int").alias("constant"))
    shapes = fixed.groupBy("h1", "h2").agg(F.bit_xor("part").alias("template"), F.sum("constant").alias("kept"))
    shapes = common.stored(mixed.join(shapes, ["h1", "h2"], "left"), "lines-shapes")
    good = f"kept >= {LEAST_CONSTANTS} and kept >= {CONSTANT_SHARE} * constants"
    return kinds, shapes.withColumn("template", F.when(F.expr(good), F.col("template"))), tokens


def recurring(docs: DataFrame, hashes: DataFrame, min_docs: int = MIN_DOCS, near: bool = False) -> DataFrame:
    """(h1, h2, f1, f2): lines whose template recurs, and the key of the
    template's first document."""
    kinds, shapes, tokens = templates(docs, hashes)
    shaped = shapes.where("template is not null")
    total = shaped.groupBy("leaf", "template").agg(F.sum("docs").alias("total"), F.min("first").alias("earliest")).where(F.col("total") >= min_docs)
    general = shaped.join(total, ["leaf", "template"]).select("h1", "h2", F.col("earliest").alias("first"))
    # a line that recurs as it stands (digits aside) needs no template
    found = general.unionByName(kinds.where(F.col("docs") >= min_docs).select("h1", "h2", "first"))
    if near:
        found = found.unionByName(similar(shapes, tokens, min_docs))
    found = found.groupBy("h1", "h2").agg(F.min("first").alias("first"))
    return found.select("h1", "h2", F.col("first.k1").alias("f1"), F.col("first.k2").alias("f2"))


def similar(mixed: DataFrame, tokens: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, first): lines that fall to a heavier line of their leaf, and
    these lines; first is that of all lines that fall to the same one."""
    stretch = F.expr(f"int({STRETCHES} * place div n)")
    parts = tokens.groupBy("h1", "h2", "leaf", "docs", stretch.alias("stretch")).agg(F.bit_xor(F.xxhash64("place", "token")).alias("part"))
    parts = common.stored(parts, "lines-stretches")
    heaviest = parts.groupBy("leaf", "stretch", "part").agg(F.max(F.struct("docs", F.col("h1").alias("l1"), F.col("h2").alias("l2"))).alias("to"), F.count("*").alias("lines")).where("lines > 1").drop("lines")
    pairs = parts.join(heaviest, ["leaf", "stretch", "part"]).where("h1 <> to.l1 or h2 <> to.l2").select("h1", "h2", "to").distinct()
    pairs = pairs.join(tokens.where("token <> '<*>'").select("h1", "h2", "place", "token"), ["h1", "h2"]).select("h1", "h2", "to", "to.l1", "to.l2", "place", "token")
    same = pairs.join(tokens.select(F.col("h1").alias("l1"), F.col("h2").alias("l2"), "place", "token"), ["l1", "l2", "place", "token"])
    same = same.groupBy("h1", "h2", "to").agg(F.count("*").alias("kept")).join(mixed.select("h1", "h2", "constants"), ["h1", "h2"])
    near = same.where(f"kept >= {LEAST_CONSTANTS} and kept >= {CONSTANT_SHARE} * constants").groupBy("h1", "h2").agg(F.max("to").alias("to")).select("h1", "h2", "to.l1", "to.l2")
    near = common.stored(near, "lines-near")
    group = near.unionByName(near.select(F.col("l1").alias("h1"), F.col("l2").alias("h2"), "l1", "l2").distinct())
    whole = group.join(mixed.select("h1", "h2", "docs", "first"), ["h1", "h2"]).groupBy("l1", "l2").agg(F.sum("docs").alias("total"), F.min("first").alias("first")).where(F.col("total") >= min_docs)
    return group.join(whole, ["l1", "l2"]).select("h1", "h2", "first")


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, near: bool = False, short: bool = False) -> DataFrame:
    """(k1, k2, dropped): the numbers, from 0, of each row's lines to drop."""
    every = common.stored(line_hashes(docs), "lines-hashes")
    hashes = every.where(f"tokens >= {LEAST_TOKENS} and constants >= {LEAST_CONSTANTS}")
    again = recurring(docs, hashes, min_docs, near)
    lines = hashes.select("k1", "k2", "at", "h1", "h2")
    if short:
        few = common.stored(short_lines(docs, every), "lines-short")
        kinds = few.select("k1", "k2", "h1", "h2").distinct().groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.min(F.struct("k1", "k2")).alias("first")).where(F.col("docs") >= min_docs)
        again = again.unionByName(kinds.select("h1", "h2", F.col("first.k1").alias("f1"), F.col("first.k2").alias("f2")))
        lines = lines.unionByName(few)
    again = common.stored(again, "lines-recurring")
    hits = lines.join(again.hint("shuffle_hash"), ["h1", "h2"])
    # dealt anew by document, so that a very common line doesn't stay in one task
    hits = hits.repartition("k1", "k2")
    earlier = Window.partitionBy("k1", "k2", "h1", "h2").orderBy("at")
    hits = hits.withColumn("n", F.rank().over(earlier)).where("n > 1 or k1 <> f1 or k2 <> f2")
    return hits.groupBy("k1", "k2").agg(F.collect_set("at").alias("dropped"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, near: bool = False, short: bool = False, counts: bool = True) -> DataFrame:
    """The documents without the dropped lines and, with ``counts``, n_lines
    and n_dropped (under these names with a mark ``_`` added where the table has
    columns of those names); n_chars, if there, follows the text."""
    a, b, cut_, drop = common.fresh(docs, "k1", "k2", "lines", "drop")
    k1, k2 = common.row_key(docs)
    drops = common.settled(lambda: dropped_lines(docs, min_docs, near, short), "lines-dropped").select(F.col("k1").alias(a), F.col("k2").alias(b), F.col("dropped").alias(drop)).hint("shuffle_hash")
    # texts cross the join as lists of lines, so that a line is found by its number
    cut = docs.withColumns({a: k1, b: k2, cut_: F.split("text", "\n")}).drop("text")
    marked = cut.join(drops, [a, b], "left")
    left = F.array_except(F.sequence(F.lit(0), F.size(cut_) - 1), F.coalesce(drop, F.expr("cast(array() as array<int>)")))
    text = F.when(F.col(cut_).isNotNull(), F.array_join(F.transform(left, lambda i: F.get(cut_, i)), "\n"))
    out = marked.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    names = [common.quoted(c) for c in docs.columns]
    if not counts:
        return out.select(*names)
    lines = F.when(F.col(cut_).isNull(), 0).otherwise(F.size(cut_)).cast("long")
    gone = F.when(F.col(drop).isNull(), 0).otherwise(F.size(drop)).cast("long")
    taken = {c.lower() for c in docs.columns}
    mark = ""
    while taken & {f"n_lines{mark}", f"n_dropped{mark}"}:
        mark += "_"
    return out.select(*names, lines.alias(f"n_lines{mark}"), gone.alias(f"n_dropped{mark}"))
