"""Quality rules, fill-in-the-middle and the filter audit against plain Python, edge cases included."""

import hashlib
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from recurra.llm import fill_middle, filter_audit, quality_rules
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string"
PROSE = "The sun was up and the wind came over the hill so that all of us could see how far it was to the sea. "
TEXTS = [
    None, "", " \n\t ", "a", PROSE * 2, PROSE, "one two three four five six seven one two three four five six seven eight",
    "x y\nx y\n x y\n\nx y", "a b c d e a b c d e a b c d e", "漢字 かな\n漢字 かな", "# $ % & | < > * #", "İ ß 𝒳 é\u0085 x",
    "THE SUN WAS UP AND ALL OF US SAW IT NOW " * 3, "- item one\n- item two\n* three\n• four\n- five\nsix seven eight nine ten...\n",
    "w" * 3000 + " " + "end " * 40, "very long " + " ".join(f"word{i}" for i in range(4000)) + " word1 word2 word3 word4 word5",
]


def repeated(words):
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    times = Counter(windows)
    return len({k + j for k, window in enumerate(windows) if times[window] > 1 for j in range(5)})


def test_quality_counts_equal_plain_python(spark):
    rows = [(i, text, ["en", None, "ja"][i % 3]) for i, text in enumerate(TEXTS)] + [(4, PROSE * 2, None), (None, PROSE, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_words", F.lit("clash")).withColumn("kept", F.lit(7))
    got = quality_rules.judged(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.text or ""
        words, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text)) and r.n_letters == sum(c.isalpha() for c in text)
        assert (r.n_lines, r.n_dup_lines) == (len(lines), len(lines) - len(set(lines)))
        assert r.n_repeat_words == repeated(words)
        assert r.base_failed == (len(words) < 10 or 100 * repeated(words) > 20 * len(words))
        assert r.kept == (not r.base_failed and not r.broken_rules)
    same = [r for r in got if r.doc_id == 4]
    assert same[0] == same[1] and same[0].base_failed and not next(r for r in got if r.doc_id is None).base_failed
    assert quality_rules.judged(docs.limit(0)).count() == 0
    assert quality_rules.judged(docs.select("doc_id", "text")).where("kept").count() > 0


def test_each_rule_of_the_table(spark):
    blocks = {
        "word_length": "supercalifragilisticexpialidocious" + " incomprehensibilities" * 12,
        "symbols": "some words | and | more | words | in | cells | of | a | table | here",
        "letters": "12345 678 9012 345 67 8901 23 456 78 90 1234 abc",
        "capitals": "ALL OF THIS IS SHOUTED AT YOU FROM VERY FAR AWAY INDEED",
        "stop_words": " ".join(f"noun{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)),
        "bullet_lines": "\n".join(f"- point {w} of many" for w in "one two three four five six".split()),
        "ellipsis_lines": "\n".join(f"so it goes {w} ..." for w in "one two three four five six".split()),
        "repeated_lines": "to be\nto be\nto be\nto be\nall of the other words stand apart in their own line here",
    }
    docs = spark.createDataFrame([(i, text, "en") for i, text in enumerate(blocks.values())], DOCS)
    got = {r.doc_id: r.broken_rules for r in quality_rules.judged(docs).collect()}
    assert all(name in got[i] for i, name in enumerate(blocks))
    assert quality_rules.judged(spark.createDataFrame([(1, PROSE, "en")], DOCS)).first().kept
    foreign = " ".join(f"слово{chr(1072 + i % 32)}{chr(1072 + i // 32)}" for i in range(60))
    chinese = "，".join(["版权所有不得转载"] * 3) + " 第二 第三 第四 第五 第六 第七 第八 第九 第十 十一"
    kept = quality_rules.judged(spark.createDataFrame([(1, foreign, "ru"), (2, chinese * 3, None), (3, foreign, None)], DOCS)).collect()
    assert [r.broken_rules for r in kept] == [[], [], []]


def test_quality_rules_keep_good_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    judged = quality_rules.judged(docs).join(labels, "doc_id").where("NOT base_failed")
    by = {r.quality: (r.n, r.kept) for r in judged.groupBy("quality").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).collect()}
    assert by[1][1] == by[1][0] and by[0][1] <= 0.1 * by[0][0]


def moved(text, doc_id):
    buffer = bytearray(text.encode())
    n, form, prefix, middle = fill_middle.transform(buffer, doc_id)
    return buffer, n, form, prefix, middle


def expected(text, doc_id):
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return text, n, "plain", None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return f"<S>{s}<P>{p}<M>{m}", n, "spm", a, b - a
    return f"<P>{p}<S>{s}<M>{m}", n, "psm", a, b - a


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="<PSM>aé漢𝒳", max_size=30)), st.integers(0, 200))
def test_fill_middle_equals_cut_and_join(text, doc_id):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    buffer, *facts = moved(text, doc_id)
    output, *wanted = expected(text, doc_id)
    assert buffer.decode() == output and facts == wanted
    fill_middle.restore(buffer, facts[1])
    assert buffer.decode() == text


def test_fill_middle_of_texts_longer_than_a_step(monkeypatch):
    text = "".join(chr(97 + i * i % 26) + "é漢𝒳"[i % 3] for i in range(90_000))
    for step in (7, 64, fill_middle.STEP):
        monkeypatch.setattr(fill_middle, "STEP", step)
        for doc_id in range(3 if step == 7 else 12):
            short = text[: 5_000 if step == 7 else None]
            buffer, n, form, *_ = moved(short, doc_id)
            assert (buffer.decode(), n, form) == expected(short, doc_id)[:3]
            fill_middle.restore(buffer, form)
            assert buffer.decode() == short
    with pytest.raises(ValueError):
        fill_middle.restore(bytearray(b"x"), "other")


@given(st.binary(max_size=200), st.integers(0, 200), st.integers(0, 200))
def test_rotation(data, middle, end):
    end = min(end, len(data))
    middle = min(middle, end)
    buffer = bytearray(data)
    fill_middle.rotate(buffer, 1 if middle else 0, middle, end)
    start = 1 if middle else 0
    assert bytes(buffer) == data[:start] + data[middle:end] + data[start:middle] + data[end:]


def test_fill_middle_columns(spark):
    rows = [(1, "abc é漢", "en"), (2, None, None), (3, "", None), (1, "abc é漢", "en"), (None, "no id at all", None), (5, "has <M> inside", None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("form", F.lit("clash")).withColumn("restored", F.lit(1))
    got = fill_middle.restored(fill_middle.transformed(docs)).collect()
    assert len(got) == 6 and all(r.restored == (r.text or "") for r in got)
    assert [r.form for r in got if r.doc_id in (2, 3, 5)] == ["plain"] * 3
    ones = [r for r in got if r.doc_id == 1]
    assert ones[0] == ones[1] and ones[0].output == expected("abc é漢", 1)[0]
    assert set(docs.columns) <= set(fill_middle.restored(fill_middle.transformed(docs)).columns)
    assert fill_middle.restored(fill_middle.transformed(docs.limit(0))).count() == 0
    invalid = spark.sql("SELECT 7L AS doc_id, CAST(X'61ff62' AS STRING) AS text")
    assert bytes(fill_middle.transformed(invalid).selectExpr("CAST(output AS BINARY) AS b").first().b).replace(b"<P>", b"")


def audit(rows, labels):
    """The contract by brute force: part, order, step -> the counts."""
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, toxic in labels if toxic == 1 and i is not None}
    sets = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and doc_id > first[text],
        }
        sets.append((lang or "", {k for k, v in fails.items() if v}, doc_id))
    out = {}
    for part in {p for p, _, _ in sets}:
        removed = Counter()
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                counts = [0] * 6
                for p, fails, doc_id in sets:
                    if p != part:
                        continue
                    before, here = fails & set(order[: step - 1]), letter in fails
                    counts[0] += not before and not here
                    counts[1] += here and not before
                    counts[2] += here and bool(before)
                    counts[3] += fails == {letter}
                    counts[4] += here and not before and doc_id in good
                    counts[5] += here and not before and doc_id in toxic
                out[part, "".join(order), step] = counts
                removed[letter] += counts[1]
        for key in out:
            if key[0] == part:
                out[key] = [*out[key], removed[key[1][key[2] - 1]]]
    return out


def test_filter_audit_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 2_000)  # many shards
    distinct = " ".join(f"w{i}" for i in range(120))
    texts = [distinct, distinct, PROSE * 8, "ABC " * 150, f"{distinct} #", None, "", "short", f"{distinct} $", distinct.upper(), "a\x0bb\x85c"]
    rows = [(i, text, ["en", "de", None, ""][i % 4]) for i, text in enumerate(texts)]
    rows += [(3, texts[3], "en"), (None, distinct, "en"), (None, None, None), (90, f"{distinct} #", "xx")]
    labels = [(i, i % 2, i % 3 - 1) for i in range(9)] + [(1, 0, 1), (None, 1, 1), (2, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("part", F.lit("clash")).withColumn("fails", F.lit(1)).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = filter_audit.filter_audit(docs, marks)
    got = {(r.part, r.filter_order, r.step): [r[name] for name in names] for r in found.collect()}
    assert got == audit(rows, labels)
    assert found.count() == len(got) == 600 * len({(lang or "") for _, _, lang in rows})
    assert filter_audit.filter_audit(docs.limit(0), marks).count() == 0
    bare = filter_audit.filter_audit(docs.select("doc_id", "text"), marks.limit(0)).where("step = 5 AND filter_order = 'ABCDE'").first()
    assert (bare.part, bare.good_lost, bare.toxic_lost) == ("", 0, 0)


def test_words_have_one_number_in_all_shards(spark, monkeypatch):
    rows = [(i, f"common word{i % 7} only{i} common", "p") for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("doc_id", "lang AS part", "'' AS digest", "false AS c", "false AS d", "text")
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 300)
    monkeypatch.setattr(filter_audit, "BUCKETS", 4)  # many words to a bucket
    stored = spark.createDataFrame(filter_audit.shards(docs.repartition(3)).collect(), filter_audit.SHARD)
    numbers = {}
    for shard in stored.collect():
        numbers.update({(shard.shard, k): word for k, word in enumerate(shard.words)})
    by_word = {}
    for r in filter_audit.dictionary(stored).collect():
        by_word.setdefault(numbers[r.shard, r.place], set()).add(r.number)
    assert len(by_word) == 68 and all(len(found) == 1 for found in by_word.values())
    assert len(set.union(*by_word.values())) == 68
    counted = {r.doc_id: (r.n_words, r.n_distinct) for r in filter_audit.word_counts(filter_audit.document_terms(stored)).collect()}
    assert counted == {i: (4, 3) for i in range(60)}


@given(st.lists(st.integers(0, 2**62), max_size=50))
def test_packing(values):
    assert filter_audit.unpacked(filter_audit.packed(np.array(values, np.int64))).tolist() == values


def test_csr_of_wordless_texts():
    words, cells, counts = filter_audit.csr(pa.array(["", None, " \n", "b a b"]))
    assert (words.to_pylist(), cells.tolist(), counts.tolist()) == (["b", "a"], [6, 7], [2, 1])


@pytest.mark.parametrize("name", ["op11_quality_rules", "op12_fill_middle", "op13_filter_audit"])
def test_twins(spark, name):
    assert difference(spark, duck(SF), name, SF) == "" and name in spark_entry.oracle_sql()
