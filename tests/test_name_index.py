"""The trigram index of tenant names and ids against the plain search."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recurra.operators.portfolio import tenant_search
from recurra.sources import name_index

LAYOUT = "tenant_id string, company_name string, plan string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tenants(spark):
    draw = random.Random(5)
    words = ["Acme", "Nordwind", "STRASSE", "Straße", "Ölwerk", "İpek", "ΟΔΟΣ", "a.b", "x[1]", "{9}", "back\\slash", "co"]
    rows = [(f"TNT_{n:06d}", " ".join(draw.choices(words, k=3)) + f" {n % 700}", draw.choice(["growth", "starter"])) for n in range(6_000)]
    rows += [("TNT_1", "Zebra Holding", "growth"), (None, "Zebra Nameless", None), ("zebra", None, "Growth"), ("q", "ab", "growth")]
    rows += [(None, None, None), ("", "", "starter"), ("TNT_1", "Zebra Holding", "growth"), ("K9", "Kelvin zebra", "growth")]
    return spark.createDataFrame(rows, LAYOUT)


@pytest.fixture(scope="module")
def index(tenants, tmp_path_factory):
    return name_index.build(tenants, str(tmp_path_factory.mktemp("names") / "index"))


@pytest.mark.parametrize("search", [
    "zebra", "ZEBRA", "^zebra$", "Zebra (Hold|Name)", "zeb.a", "zebr?a", "zebraa?", "zebra|acme co.* 69[89]$", "nameless|q", "ab",
    "tnt_00012[34]", r"a\.b", r"x\[1\]", r"x[\[]1[\]]", "[^x]ebra", r"\Qzebra\E", r"\x7aebra", "(?x) zebra", "(?-i)Zebra", "zebra{1,2}", "(zebra)+",
    "zebra+", "(?:holding)?", "holding*", r"back\\slash", "straße", "STRASSE 1", "ölwerk", "kelvin", ".*", "zebra holding|", "no such name", r"\bzebra\b",
])
def test_patterns_find_what_the_plain_search_finds(tenants, index, search):
    assert rows_of(index.search(search)) == rows_of(tenant_search(tenants, search))


@pytest.mark.parametrize("search", ["zebra h", "(north)", "a.b", "{9}", "ΟΔΟΣ", "İpek", "straße", "ab", "", "q", "back\\slash", "TNT_0001"])
def test_literal_texts_find_what_the_plain_search_finds(tenants, index, search):
    assert rows_of(index.search(search, literal=True)) == rows_of(tenant_search(tenants, search, literal=True))


@given(st.text("abc.|*+?()[]{}\\^$12,dQ-:=!<", max_size=12), st.lists(st.text("abc12.,d", max_size=9), max_size=12))
@settings(max_examples=600, deadline=None)
def test_demanded_trigrams_are_in_every_match(search, names):
    """Python's patterns of these characters mean what Java's do where they compile in both and nothing unusual is in them."""
    branches = name_index.demanded(search)
    try:
        pattern = re.compile(f"(?i){search}")
    except (re.error, OverflowError):
        return
    for name in names:
        if branches and pattern.search(name):
            assert any(all(gram in name.lower() for gram in grams) for grams in branches)


def test_demanded():
    assert name_index.demanded("Acme") == [{"acm", "cme"}]
    assert name_index.demanded("acme|(b)cde") == [{"acm", "cme"}, {"cde"}]
    assert name_index.demanded("acme?s") == [{"acm"}]
    assert name_index.demanded(r"ab\.c[xyz]def") == [{"ab.", "b.c", "def"}]
    for unsure in ["ab", "acme|x", "(acme)", "(?x)acme", r"\Qacme\E", r"\u0041cme", "acme{", "[]a]cme", "(acme", "acme)"]:
        assert name_index.demanded(unsure) is None, unsure


def test_few_candidates_read_their_buckets_and_ids_only(index):
    text = plan(index.search("tnt_00012[34]$|nameless"))
    read = text[text.index("FileScan") :]
    assert re.search(r"PartitionFilters: \[[^\]]*row_bucket#\d+ (IN|=)", read), read
    assert "In(tenant_id" in read or "GreaterThanOrEqual(tenant_id" in read or "EqualTo(tenant_id" in read or "Or(" in read
    assert "FileScan" not in plan(index.search("no such name"))
    holders = plan(index.holders([["ebr", "zeb"]]))
    assert re.search(r"PartitionFilters: \[[^\]]*gram_slot#\d+ IN", holders) and "In(gram, [ebr,zeb])" in holders


def test_many_candidates_meet_in_a_join(tenants, index, monkeypatch):
    monkeypatch.setattr(name_index, "NAMED", 1)
    monkeypatch.setattr(name_index, "COMMON", 1.0)
    for search in ["zebra", "acme", "nameless|holding"]:
        found = index.search(search)
        assert "LeftSemi" in plan(found)
        assert rows_of(found) == rows_of(tenant_search(tenants, search))


def test_common_trigrams_read_all_rows(index):
    assert "row_bucket" not in plan(index.search("tnt_.*7")).split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_extended_reopened_and_empty_index(spark, tmp_path):
    path = str(tmp_path / "index")
    assert name_index.open_or_none(spark, path) is None
    first = spark.createDataFrame([("T1", "First Ltd", "growth")], LAYOUT)
    second = spark.createDataFrame([("T2", "Second Ltd", "growth"), ("T3", "first again", None)], LAYOUT)
    name_index.build(first.limit(0), path)
    index = name_index.open_or_none(spark, path)
    assert rows_of(index.search("first")) == rows_of(index.search("")) == []
    index.extend(first)
    index.extend(second)
    assert rows_of(index.search("first")) == [("T1", "First Ltd", "growth"), ("T3", "first again", None)]
    assert rows_of(index.search("ltd", "growth")) == rows_of(tenant_search(first.union(second), "ltd", "growth"))
    assert name_index.build(second, path).search("first").count() == 1
