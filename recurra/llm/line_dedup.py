"""Recurring lines by a log-template tree of fixed depth, in Spark columns only.

A line's tokens are its runs without blanks; a token with a digit in it is a variable field and counts as ``<*>``. The
tree has a level for the number of tokens and one for each of the first ``DEPTH`` tokens, so a path through it is a leaf of lines
that may share a template. Within a leaf a token behind the path is constant at its position if at least ``MIN_DOCS`` lines
of different documents or of different wording have it there, and a variable field otherwise; ``<*>`` never is a constant. A line's template
is its path with its constants. A template recurs if at least ``MIN_DOCS`` documents have lines of it and constants make up at least
``SIMILARITY`` of the tokens behind the path, so that for short lines all of them have to agree. Its lines are dropped but for those of the
first document (by doc_id). Lines of fewer than ``MIN_TOKENS`` tokens have no template.

Apart from templates, a line of at least ``LONG_CHARS`` code points that stands word for word (blanks aside, digits included) in
several documents is dropped from the second one on, whatever its number of tokens. One of at least ``SHORT_CHARS`` is dropped
there if at least ``MIN_DOCS`` documents have it; shorter ones recur by chance and stay.

Blanks are put in order once a text, before it is split. Shuffles carry a few numbers for every distinct line of a document, tokens only
for distinct lines in leaves that several documents share. A leaf or a line with a third of all lines is counted before it is
shuffled, and joins on leaves are plain equi-joins that adaptive execution splits. Lines are told apart by 64-bit hashes.

Defined results: a null text has no lines and stays null; blank lines are never dropped; a document whose lines are all dropped has an
empty text. Rows without doc_id are left as they are and bring nothing. Rows that repeat a doc_id are one document, whose lines are
those of all its texts; each row loses its own lines. Other columns stay, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.shared import checkpoint

DEPTH = 3
MIN_DOCS = 3
MIN_TOKENS = 4
SIMILARITY = 0.6
LONG_CHARS = 20
SHORT_CHARS = 10
BROADCAST_LEAVES = 1_000_000

FIELD = "<*>"
#: Blanks that aren't one space between two tokens; a single space is passed over.
ODD_BLANKS = r"(?: (?=[ \t\r\f\x0B])|[\t\r\f\x0B])[ \t\r\f\x0B]*+"
#: A token from its first character to a digit without ever going back, so that its cost is its length.
NUMBERED = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*"


def tidy_lines(text: Column) -> Column:
    """The lines of a text, each with single blanks between its tokens."""
    # most texts have none, which a search for bytes tells much faster than a pattern
    odd = reduce(or_, (F.contains(text, F.lit(blanks)) for blanks in ("  ", "\t", "\r", "\f", "\x0b")))
    single = F.when(odd, F.regexp_replace(text, ODD_BLANKS, " ")).otherwise(text)
    for edge in (" \n", "\n "):
        single = F.replace(single, F.lit(edge), F.lit("\n"))
    return F.split(F.btrim(single), "\n")


def masked(line: Column) -> Column:
    """A tidy line with ``<*>`` for tokens with a digit."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, NUMBERED, FIELD)).otherwise(line)


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, same, needed, leaf, content, masked: the distinct lines of each text that can recur.

    ``same`` marks the line word for word, ``needed`` says how many documents make that recur (null: none do), ``content`` marks
    the masked line and ``leaf`` its path (null: no template).
    """
    distinct = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.explode(F.array_distinct(tidy_lines(F.col("text")))).alias("line")
    )
    line, size = F.col("line"), F.length("line")
    n_tokens = size - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    # no line under this length can recur; the filter looks at nothing else, so that nothing is computed twice
    known = distinct.where(size >= min(SHORT_CHARS, 2 * MIN_TOKENS - 1)).select(
        "doc_id", "line", n_tokens.alias("n_tokens"), masked(line).alias("masked")
    )
    in_tree = F.col("n_tokens") >= MIN_TOKENS
    return known.select(
        "doc_id",
        F.xxhash64("line").alias("same"),
        F.when(size >= LONG_CHARS, 2).when(size >= SHORT_CHARS, MIN_DOCS).alias("needed"),
        F.when(in_tree, F.xxhash64("n_tokens", F.substring_index("masked", " ", DEPTH))).alias("leaf"),
        F.when(in_tree, F.xxhash64("masked", F.lit(1))).alias("content"),
        "masked",
    )


def repeated(found: DataFrame) -> DataFrame:
    """doc_id, same: the lines that enough documents have word for word, but for those of the first."""
    groups = (
        found.where(F.col("needed").isNotNull())
        .groupBy("same", "needed")
        .agg(F.countDistinct("doc_id").alias("n_docs"), F.min("doc_id").alias("first"))
        .where(F.col("n_docs") >= F.col("needed"))
    )
    return found.join(groups.select("same", "first"), "same").where(F.col("doc_id") > F.col("first")).select("doc_id", "same")


def templated(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, same: the lines of recurring templates, but for those of each one's first document.

    The texts are read a second time for the lines of busy leaves, as that costs less than carrying every line along. Leaves are
    numbers of eight bytes; up to ``BROADCAST_LEAVES`` of them go to the tasks, more than that meet the lines in a shuffle.
    """
    busy = found.where(F.col("leaf").isNotNull()).groupBy("leaf").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")
    )
    busy = checkpoint(busy.where((F.col("n") >= MIN_DOCS) & (F.col("lo") < F.col("hi"))).select("leaf"))
    leaves = F.broadcast(busy) if busy.count() <= BROADCAST_LEAVES else busy
    shared = checkpoint(lines(docs).drop("needed").join(leaves, "leaf", "left_semi"))
    contents = shared.groupBy("leaf", "content").agg(F.countDistinct("doc_id").alias("n_docs"))
    texts = shared.groupBy("leaf", "content").agg(F.min("masked").alias("line"))
    templates = checkpoint(_templates(contents.join(texts, ["leaf", "content"])))
    members = shared.join(templates, ["leaf", "content"]).select("doc_id", "same", "leaf", "template")
    recurring = (
        members.groupBy("leaf", "template")
        .agg(F.countDistinct("doc_id").alias("n_docs"), F.min("doc_id").alias("first"))
        .where(F.col("n_docs") >= MIN_DOCS)
        .select("leaf", "template", "first")
    )
    return members.join(recurring, ["leaf", "template"]).where(F.col("doc_id") > F.col("first")).select("doc_id", "same")


def _templates(contents: DataFrame) -> DataFrame:
    """leaf, content, template of the lines that have enough constants; a template is a checksum of its constants and their places."""
    with_size = contents.withColumn("behind", F.size(F.split("line", " ")) - DEPTH)
    tokens = with_size.select("leaf", "content", "n_docs", "behind", F.posexplode(F.split("line", " ")).alias("at", "token"))
    behind = tokens.where((F.col("at") >= DEPTH) & (F.col("token") != FIELD))
    constants = behind.groupBy("leaf", "at", "token").agg(F.sum("n_docs").alias("support")).where(F.col("support") >= MIN_DOCS)
    return (
        behind.join(constants.select("leaf", "at", "token"), ["leaf", "at", "token"])
        .groupBy("leaf", "content", "behind")
        .agg(F.count("*").alias("constant"), F.bit_xor(F.xxhash64("at", "token")).alias("template"))
        .where(F.col("constant") >= SIMILARITY * F.col("behind"))
        .select("leaf", "content", "template")
    )


def recurring(docs: DataFrame) -> DataFrame:
    """doc_id, dropped: the hashes (``same``) of the lines that a document loses, for documents that lose any."""
    found = checkpoint(lines(docs).drop("content", "masked"))
    return repeated(found).union(templated(docs, found)).groupBy("doc_id").agg(F.collect_set("same").alias("dropped"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with recurring lines taken out of text, and n_lines, n_dropped (null texts: 0 and 0)."""
    found = recurring(docs.select("doc_id", "text")).withColumnRenamed("dropped", "_dropped")
    rest = docs.drop("n_lines", "n_dropped")
    hashes = F.when(F.col("_dropped").isNotNull(), F.transform(tidy_lines(F.col("text")), lambda line: F.xxhash64(line)))
    joined = rest.join(found, "doc_id", "left").withColumn("_hashes", hashes)
    kept = F.expr("filter(split(text, '\\n'), (line, at) -> NOT array_contains(_dropped, _hashes[at]))")
    lost = F.expr("size(filter(_hashes, hash -> array_contains(_dropped, hash)))")
    return joined.select(
        *(
            F.when(F.col("_dropped").isNull(), F.col(name)).otherwise(F.array_join(kept, "\n")).alias(name)
            if name == "text"
            else F.col(f"`{name}`")
            for name in rest.columns
        ),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size(F.split("text", "\n"))), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("_hashes").isNotNull(), lost), F.lit(0)).cast("long").alias("n_dropped"),
    )
