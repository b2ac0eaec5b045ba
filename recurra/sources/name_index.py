"""Tenants stored for searching: an inverted index of the trigrams of names and ids.

Below ``path`` lie

- ``rows``, a directory per bucket of tenant ids, sorted by id: the tenants, with all their columns;
- ``grams``, a directory per slot of trigrams, sorted by trigram: which name or id holds which trigram, in lower case. A trigram that
  every id shares has a row per tenant, in files of bounded size, and no list of them;
- ``counts``: how many rows a trigram has, added up over appends; the empty trigram counts the tenants;
- ``layout``: the columns of the tenants, written last, so that an index without it was broken off.

A search takes the trigrams that every match must hold, reads the postings of the rarest, and then those buckets of
``rows`` they name. What is found there is matched as in :func:`~recurra.operators.portfolio.tenant_search`, so the result is the same,
whatever the index let through. A pattern that demands no trigram, or whose rarest one is common, reads all rows.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from recurra.operators.portfolio import tenant_search
from recurra.sources.files import load_or_empty

GRAM = 3
SLOTS = 64
BUCKETS = 64
# The rarest trigrams of an alternative are looked up; more would narrow the candidates little.
RAREST = 3
# Up to this many candidates are named in the scan of the rows; more meet them in a join.
NAMED = 256
# Where the rarest trigram is in a larger share of tenants, all rows are read at once.
COMMON = 0.1

_FIELDS = ["company_name", "tenant_id"]
_GRAMS = "gram STRING, field STRING, tenant_id STRING, row_bucket INT, gram_slot INT"
_COUNTS = "gram STRING, n LONG"
# Escapes of one letter that stand for no fixed character, or for one that no trigram is taken from.
_ONE_LETTER = set("dDsSwWbBAGzZRhHvVnrtfae")


def _windows(text: str) -> set[str]:
    return {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}


def _class_end(pattern: str, at: int) -> int | None:
    """The place behind a character class whose content starts at ``at``; None where it isn't plain to see."""
    at += pattern[at : at + 1] == "^"
    if pattern[at : at + 1] == "]":
        return None
    depth = 1
    while depth and at < len(pattern):
        if pattern[at : at + 2] == "\\Q":
            return None
        depth += {"[": 1, "]": -1}.get(pattern[at], 0)
        at += 2 if pattern[at] == "\\" else 1
    return None if depth else at


def demanded(search: str, literal: bool = False) -> list[set[str]] | None:
    """The trigrams that a match must hold, in lower case, for each alternative of the search; None if there may be none.

    Of a regular expression only plain ASCII characters outside of groups and classes count, which no quantifier makes optional.
    Anything unusual gives None: it costs a scan and never a row.
    """
    if literal:
        needle = search.lower()
        return [_windows(needle)] if len(needle) >= GRAM else None
    branches: list[set[str]] = [set()]
    run, depth, at = "", 0, 0
    while at < len(search):
        char, at = search[at], at + 1
        plain = None
        if char == "\\":
            letter, at = search[at : at + 1], at + 1
            if not letter or (letter.isalnum() and letter not in _ONE_LETTER):
                return None
            plain = None if letter.isalnum() else letter
        elif char == "[":
            end = _class_end(search, at)
            if end is None:
                return None
            at = end
        elif char == "(":
            if search[at : at + 1] == "?" and search[at + 1 : at + 2] not in {":", "=", "!", "<", ">"}:
                return None  # flags may change what the rest means
            depth += 1
        elif char == ")":
            depth -= 1
        elif char in "*?{":
            run = run[:-1]
            if char == "{":
                at = search.find("}", at) + 1
        elif char not in "+.^$|":
            plain = char
        if depth < 0 or (char == "{" and at == 0):
            return None
        if plain and plain.isascii() and not depth:
            run += plain.lower()
            continue
        branches[-1] |= _windows(run)
        run = ""
        if char == "|" and not depth:
            branches.append(set())
    branches[-1] |= _windows(run)
    return branches if all(branches) and not depth else None


def _bucket(tenant_id: Column) -> Column:
    return F.pmod(F.xxhash64(tenant_id), F.lit(BUCKETS)).cast("int")


def _postings(tenants: DataFrame) -> DataFrame:
    none = F.array().cast("array<struct<field:string,gram:string>>")

    def entries(field: str) -> Column:
        low = F.lower(field)
        starts = F.when(F.length(low) >= GRAM, F.sequence(F.lit(1), F.length(low) - (GRAM - 1)))
        grams = F.array_distinct(F.transform(starts, lambda start: F.substring(low, start, F.lit(GRAM))))
        return F.coalesce(F.transform(grams, lambda gram: F.struct(F.lit(field).alias("field"), gram.alias("gram"))), none)

    each = F.explode(F.concat(*map(entries, _FIELDS)))
    return tenants.select("tenant_id", each.alias("entry")).select(
        "entry.gram",
        "entry.field",
        "tenant_id",
        _bucket(F.col("tenant_id")).alias("row_bucket"),
        F.pmod(F.crc32(F.col("entry.gram").cast("binary")), F.lit(SLOTS)).cast("int").alias("gram_slot"),
    )


class Index:
    """An index opened for searching."""

    def __init__(self, spark: SparkSession, path: str, layout: StructType):
        self.spark, self.path, self.layout = spark, path, layout

    def _add(self, tenants: DataFrame, mode: str) -> None:
        placed = tenants.withColumn("row_bucket", _bucket(F.col("tenant_id"))).hint("rebalance", "row_bucket")
        placed = placed.sortWithinPartitions("row_bucket", "tenant_id")
        placed.write.mode(mode).partitionBy("row_bucket").parquet(f"{self.path}/rows")
        postings = _postings(tenants)
        kept = postings.hint("rebalance", "gram_slot").sortWithinPartitions("gram_slot", "gram")
        kept.write.mode(mode).partitionBy("gram_slot").parquet(f"{self.path}/grams")
        counts = postings.groupBy("gram").agg(F.count("*").alias("n"))
        total = tenants.agg(F.count("*").alias("n")).select(F.lit("").alias("gram"), "n")
        counts.unionByName(total).hint("rebalance").sortWithinPartitions("gram").write.mode(mode).parquet(f"{self.path}/counts")

    def extend(self, tenants: DataFrame) -> None:
        """Adds tenants that aren't in the index yet, in the columns it was built with."""
        self._add(tenants.select(self.layout.names), "append")

    def rows(self) -> DataFrame:
        """All tenants, and the bucket each lies in."""
        schema = StructType([*self.layout.fields, StructField("row_bucket", IntegerType())])
        return load_or_empty(self.spark, f"{self.path}/rows", schema)

    def _counts(self, grams: set[str]) -> dict[str, int]:
        """How many rows each of the trigrams of one pattern has, and the empty one for all tenants."""
        stored = load_or_empty(self.spark, f"{self.path}/counts", StructType.fromDDL(_COUNTS))
        asked = stored.where(F.col("gram").isin(sorted(grams | {""})))
        return {row.gram: row.n for row in asked.groupBy("gram").agg(F.sum("n").alias("n")).collect()}

    def holders(self, branches: list[list[str]]) -> DataFrame:
        """tenant_id, row_bucket: tenants whose name or id holds all trigrams of one of the branches."""
        grams = sorted(set().union(*branches))
        slots = sorted({zlib.crc32(gram.encode()) % SLOTS for gram in grams})
        stored = load_or_empty(self.spark, f"{self.path}/grams", StructType.fromDDL(_GRAMS))
        hits = stored.where(F.col("gram_slot").isin(slots) & F.col("gram").isin(grams))
        held = hits.groupBy("tenant_id", "row_bucket", "field").agg(F.collect_set("gram").alias("held"))
        whole = F.lit(False)
        for branch in branches:
            whole = whole | (F.size(F.array_intersect("held", F.array(*map(F.lit, branch)))) == len(branch))
        return held.where(whole).select("tenant_id", "row_bucket").distinct()

    def candidates(self, search: str, literal: bool = False) -> DataFrame:
        """The stored rows that may match, all that do among them."""
        rows, branches = self.rows(), demanded(search, literal) if search else None
        if branches is None:
            return rows
        counts = self._counts(set().union(*branches))
        known = [sorted(grams, key=lambda g: (counts[g], g))[:RAREST] for grams in branches if grams <= counts.keys()]
        if not known:
            return rows.where(F.lit(False))
        if sum(counts[grams[0]] for grams in known) > COMMON * counts[""]:
            return rows
        holders = self.holders(known)
        named = holders.limit(NAMED + 1).collect()
        if len(named) > NAMED:
            same = F.col("r.row_bucket").eqNullSafe(F.col("h.row_bucket")) & F.col("r.tenant_id").eqNullSafe(F.col("h.tenant_id"))
            return rows.alias("r").join(holders.alias("h"), same, "left_semi")
        ids = sorted({row.tenant_id for row in named} - {None})
        is_named = F.col("tenant_id").isin(ids)
        if any(row.tenant_id is None for row in named):
            is_named = is_named | F.col("tenant_id").isNull()
        return rows.where(F.col("row_bucket").isin(sorted({row.row_bucket for row in named})) & is_named)

    def search(self, search: str = "", plan: str = "all", literal: bool = False) -> DataFrame:
        """What :func:`tenant_search` finds among all stored tenants."""
        return tenant_search(self.candidates(search, literal), search, plan, literal).select(self.layout.names)


def build(tenants: DataFrame, path: str) -> Index:
    """A new index at ``path`` of ``tenants`` (tenant_id, company_name and any other columns), in the place of what is there.

    A name or id of less than three characters has no trigrams, and no pattern that demands one matches it. NULL names and ids are
    never matched; their rows are stored. Rows that repeat an id are found one by one.
    """
    spark = tenants.sparkSession
    index = Index(spark, path, tenants.schema)
    index._add(tenants, "overwrite")
    layout = spark.range(1).select(F.lit(tenants.schema.json()).alias("layout"))
    layout.write.mode("overwrite").parquet(f"{path}/layout")
    return index


def open_or_none(spark: SparkSession, path: str) -> Index | None:
    """The index at ``path``, or none where there isn't a whole one."""
    row = load_or_empty(spark, f"{path}/layout", StructType.fromDDL("layout STRING")).first()
    return Index(spark, path, StructType.fromJson(json.loads(row.layout))) if row else None
