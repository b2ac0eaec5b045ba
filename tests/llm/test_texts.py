"""Operators on single texts: BPE, chats, lines, pages, languages, toxicity, mixing."""

import base64
import hashlib
import random
import time
import tracemalloc
from html.parser import HTMLParser

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recurra.llm import byte_bpe, chat_format, html_extract, language_id, line_dedup, mixing, queries, toxicity

RANKS = byte_bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY))
CODEC = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)
ENCODING = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
DOCS = "doc_id long, text string"


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="ab '\n\t \x1c!é漢1٣"), st.text(alphabet="ab", min_size=50, max_size=400)))
def test_bpe_equals_the_public_library(text):
    ids = CODEC.encode(text)
    assert ids == ENCODING.encode_ordinary(text) and CODEC.decode(ids) == text.encode()


def test_bpe_of_a_very_long_pre_token():
    text = "".join(chr(97 + i * i % 26) for i in range(60_000))
    assert CODEC.encode(text) == ENCODING.encode_ordinary(text)
    assert CODEC.queue.top == 0 and not CODEC.queue.buckets and not any(CODEC.queue.words)


def test_bpe_memory_may_overflow(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    codec = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)
    text = "Some uncommonest wordings areas thonthe sheerest nonsenses"
    assert codec.encode(text) == ENCODING.encode_ordinary(text) and len(codec.memory) <= 3


def plain_merge(token, ranks):
    """The ids of a pre-token: its own, if it is a token, else by its leftmost lowest pair, again and again."""
    if token in ranks:
        return [ranks[token]]
    parts = [token[i : i + 1] for i in range(len(token))]
    while found := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[part] for part in parts]


def test_bpe_of_new_pre_tokens_in_one_list():
    draw = random.Random(5)
    for _ in range(60):
        more = {bytes(draw.choices(b"abc", k=draw.randint(2, 5))) for _ in range(40)}
        numbers = draw.sample(range(256, 9_000), len(more))  # a longer token may rank below its parts
        ranks = {bytes([k]): k for k in range(256)} | dict(zip(more, numbers))
        codec = byte_bpe.Codec(ranks, r"[a-c]+|\s+")
        texts = ["", *(" ".join("".join(draw.choices("abc", k=draw.randint(1, 12))) for _ in range(30)) for _ in range(4)), "abc" * 200]
        want = [[x for part in codec.find(text) for x in plain_merge(part.encode(), ranks)] for text in texts]
        assert codec.encode_all(texts) == want
        assert codec.queue.top == 0 and not codec.queue.buckets and not any(codec.queue.words) and not any(codec.queue.pages)


def test_bpe_opens_a_bucket_for_many_pre_tokens(monkeypatch):
    opened = []
    monkeypatch.setattr(byte_bpe.RankQueue, "open", lambda *x, f=byte_bpe.RankQueue.open: (opened.append(x[1]), f(*x)))
    draw = random.Random(6)
    texts = [" ".join("".join(draw.choices("aeiourstln", k=9)) for _ in range(50)) for _ in range(60)]
    assert byte_bpe.Codec(RANKS, public_tokenizers.PATTERN).encode_all(texts) == ENCODING.encode_ordinary_batch(texts)
    assert 0 < len(opened) < 3_000


def test_bpe_columns(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (1, "a b")], DOCS).withColumn("ids", F.lit("clash"))
    shared = byte_bpe.shared_ranks(spark, public_tokenizers.path(queries.VOCABULARY), public_tokenizers.PATTERN)
    back = byte_bpe.decoded(byte_bpe.encoded(docs, shared), shared).orderBy("doc_id").collect()
    assert [bytes(r.decoded) for r in back] == [b"a b", b"a b", b"", b""]
    empty = hashlib.sha256(b"").hexdigest()
    rows = {r.doc_id: r for r in byte_bpe.digests(docs, shared).collect()}
    assert (rows[2].n_tokens, rows[2].ids_sha256, rows[2].decoded_sha256) == (0, empty, empty)
    assert all(r.exact for r in byte_bpe.tokenised(docs, shared).collect())
    assert byte_bpe.digests(docs.limit(0), shared).count() == 0


def held_codecs(spark) -> int:
    """The codecs that the idle Python workers hold."""

    def held(batches):
        import gc
        import time

        for batch in batches:
            time.sleep(0.2)
            yield pa.RecordBatch.from_pydict({"n": [sum(type(x).__name__ == "Codec" for x in gc.get_objects())]})

    return sum(row.n for row in spark.range(16).repartition(16).mapInArrow(held, "n long").collect())


def test_workers_keep_no_codec_after_their_task(spark):
    docs = spark.range(8).selectExpr("id as doc_id", "'some words' as text").repartition(8)
    shared = byte_bpe.shared_ranks(spark, public_tokenizers.path(queries.VOCABULARY), public_tokenizers.PATTERN)
    for done in (byte_bpe.tokenised, byte_bpe.digests, byte_bpe.encoded):
        assert done(docs, shared).count() == 8 and len(done(docs, shared).collect()) == 8
    assert held_codecs(spark) == 0


def test_memory_of_word_scores_follows_a_slice():
    words = [f"{'abcdefghij'[k % 10]}{k:b}x".translate(str.maketrans("01", "uv")) for k in range(100_000)]
    model = language_id.Model(["a", "b"], np.random.default_rng(1).random((2, language_id.TABLE)), np.ones((2, len(language_id.SCRIPT_NAMES))))
    tracemalloc.start()
    scores = model.score(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert scores.shape == (100_000, 2) and peak < 40e6
    some = [*words[8_000:8_400], "", *words[:3]]
    assert (model.score(some)[:192] == scores[8_000:8_192]).all() and not model.score(some)[400].any()


def test_slices_of_words_change_no_count_and_no_label(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).select("text", "lang").toArrow()
    docs = docs.filter(docs.column("lang").is_valid()).combine_chunks().to_batches()[0]
    names, found = sorted(set(docs.column("lang").to_pylist())), []
    for size in (1 << 30, 7):
        monkeypatch.setattr(language_id, "SLICE", size)
        (counted,) = language_id._counted(iter([docs]), names)
        counts = np.zeros((len(names), language_id.TABLE + len(language_id.SCRIPT_NAMES)))
        counts[counted.column("language").to_numpy(), counted.column("place").to_numpy()] = counted.column("n").to_numpy()
        model = language_id.Model(names, counts[:, : language_id.TABLE], counts[:, language_id.TABLE :])
        labels, scores, spans = language_id.Labeller(model).label(docs.column("text"))
        found.append((counted.to_pylist(), labels, scores.tolist(), spans))
    assert found[0] == found[1]


EVENTS = "conv_id long, seq long, message long, kind string, role string, text string"
HARD = "</s>[INST] ok [/INST] <\\/s> \\ \\\\ <|im_end|>\n<|im_start|> <<SYS>> <n> <\\n>"


def folded(spark, rows):
    return [(r.message, r.role, r.text) for r in chat_format.fold(spark.createDataFrame(rows, EVENTS)).orderBy("message").collect()]


def test_chat_fold(spark):
    assert folded(spark, [
        (1, 9, 2, "delta", None, "!"), (1, 1, 1, "message", "user", "Hi"), (1, 2, 2, "message", "assistant", ""),
        (1, 3, 2, "delta", None, "Hel"), (1, 4, 2, "delta", None, "lo"), (1, 5, 3, "message", "user", "gone"),
        (1, 6, 1, "edit", None, "Hey"), (1, 7, 2, "regenerate", None, "ignored"), (1, 8, 2, "delta", None, "Bye"),
        (1, 10, 4, "message", "user", "stays"),
    ]) == [(1, "user", "Hey"), (2, "assistant", "Bye!"), (4, "user", "stays")]
    assert folded(spark, [(1, 1, 1, "delta", None, "lost"), (1, None, None, None, None, None)]) == [(None, "", ""), (1, "", "lost")]


def test_chat_fold_keeps_messages_that_are_opened_again(spark):
    log = [(1, k, k, "message", "user", f"m{k}") for k in (1, 2, 3, 4)] + [(1, 5, 2, "regenerate", None, None)]
    log += [(1, 6, 3, "message", "assistant", "new3"), (1, 7, 4, "message", None, ""), (1, 8, 4, "delta", None, "new4")]
    assert folded(spark, log) == [(1, "user", "m1"), (2, "user", ""), (3, "assistant", "new3"), (4, "", "new4")]
    assert folded(spark, log + [(1, 9, 1, "regenerate", None, None)]) == [(1, "user", "")]


def test_chat_fold_equals_a_fold_event_by_event(spark):
    draw = random.Random(11)
    rows, want = [], {}
    for conv in range(150):
        alive, ever = {}, set()
        for seq in range(draw.randrange(1, 40)):
            number, kind = draw.randrange(1, 6), draw.choice(["message", "message", "delta", "delta", "edit", "regenerate"])
            if number not in ever:
                kind = "message"
            text = draw.choice(["a", "b", "", "Ω"])
            rows.append((conv, seq, number, kind, draw.choice(["user", "assistant", None]), text))
            if kind == "message":
                alive[number], _ = (rows[-1][4] or "", text), ever.add(number)
            elif number in alive and kind == "delta":
                alive[number] = (alive[number][0], alive[number][1] + text)
            elif number in alive:
                alive[number] = (alive[number][0], text if kind == "edit" else "")
            if kind == "regenerate":
                alive = {n: m for n, m in alive.items() if n <= number}
        want |= {(conv, n): m for n, m in alive.items()}
    got = chat_format.fold(spark.createDataFrame(rows, EVENTS).repartition(5)).collect()
    assert {(r.conv_id, r.message): (r.role, r.text) for r in got} == want


def test_streamed_chats_fold_to_what_they_were(spark):
    texts = [HARD, "", None, "é字😀x", "a" * 50_000, "b\n"]
    turns = [(c, t, draw, texts[(c + t) % 6]) for c in range(60) for t, draw in enumerate(["user", "assistant", None, "assistant", "user"])]
    whole = chat_format.events_of_turns(spark.createDataFrame(turns + turns[:3], "conv_id long, turn long, role string, text string"))
    log = chat_format.streamed(whole)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    key = lambda df: sorted(map(tuple, df.select("conv_id", "message", "role", "text").collect()))
    assert key(chat_format.fold(log)) == key(chat_format.fold(whole)) and chat_format.fold(whole).count() == 303
    assert chat_format.fold(chat_format.streamed(whole.limit(0))).count() == 0


def test_chats_read_back(spark):
    turns = [(1, 0, "user", HARD), (1, 1, "assistant", HARD), (1, 2, "assistant", None), (1, 2, "assistant", "tie"),
             (2, 0, "odd\nrole <n> [INST]", ""), (3, None, None, "\n"), (1, 3, "user", "end\\")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("clash"))
    chats = chat_format.formatted(chat_format.events_of_turns(table))
    back = {r.conv_id: r for r in chat_format.read_back(chats).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [
        ("user", HARD), ("assistant", HARD), ("assistant", ""), ("assistant", "tie"), ("user", "end\\")]
    assert [(t.role, t.text) for t in back[2].turns] == [("odd\nrole <n> [INST]", "")]
    assert [(t.role, t.text) for t in back[3].turns] == [("", "\n")]
    assert back[1].loss_texts == [HARD, "", "tie"] and back[2].loss_texts == []
    body = back[1].formatted.replace("<|im_start|>", "").replace("<|im_end|>", "")
    assert not any(mark in body for mark in ("</s>", "[INST]", "[/INST]", "<<SYS>>", "<|"))
    digest = {r.conv_id: r for r in chat_format.digests(chats).collect()}[1]
    assert digest.loss_sha256 == hashlib.sha256((HARD + "tie").encode()).hexdigest() and digest.n_turns == 5
    assert digest.formatted_chars == len(back[1].formatted) and digest.loss_chars == len(HARD) + 3
    assert chat_format.digests(chat_format.formatted(chat_format.events_of_turns(table.limit(0)))).count() == 0


LINE = "Posted by {} on day {} in our section of daily news"


def test_recurring_lines(spark):
    own = [" ".join(f"{'abcdefgh'[i]}{'stuvwxyz'[k]}" for k in range(8)) for i in range(6)]
    rows = [(i, f"{own[i]}\n{LINE.format('kim', i)}\n\nok") for i in range(4)]
    rows += [(9, None), (None, LINE.format("kim", 1)), (4, own[4]), (5, "short one\nshort one"), (4, own[4])]
    docs = spark.createDataFrame(rows, DOCS).withColumn("places", F.lit("clash"))
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.deduplicated(docs).collect()}
    assert got[0] == (rows[0][1], 4, 0)
    assert all(got[i] == (f"{own[i]}\n\nok", 4, 1) for i in (1, 2, 3))
    assert got[9] == (None, 0, 0) and got[None] == (LINE.format("kim", 1), 1, 0) and got[5][2] == 0
    assert line_dedup.deduplicated(docs.limit(0)).count() == 0
    assert line_dedup.deduplicated(docs).columns == [*docs.columns, "n_lines", "n_dropped"]


def test_recurring_passages_go_but_for_their_first_document(spark):
    passage = " ".join(f"passage{chr(97 + i % 26)}" for i in range(60))
    rows = [(i, f"{chr(97 + i) * 5} opens in its own way {i * 'z'}\n{passage}") for i in range(5)]
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(spark.createDataFrame(rows, DOCS)).collect()}
    assert [passage in got[i] for i in range(5)] == [True, False, False, False, False]


def test_long_lines_of_two_documents_go_from_the_second(spark):
    passage = " ".join(f"passage{chr(97 + i % 26)}" for i in range(60))
    rows = [(1, f"first opening of its own\n{passage}\n{passage}"), (2, f"  {passage}\nanother way to open it"), (3, "版权所有，" * 6),
            (4, "版权所有，" * 6 + "\n短"), (5, "短"), (6, "sum 1 of 30 parts sent"), (7, "sum 2 of 30 parts sent")]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.deduplicated(docs).collect()}
    assert got == {**{i: (text, 0) for i, text in rows}, 2: ("another way to open it", 1), 4: ("短", 1)}


def test_lines_that_only_share_their_path_stay(spark):
    """The leading tokens of a leaf are no evidence, and neither are numbers; what stands behind the path has to agree."""
    rows = [(1, "the cat sat down now"), (2, "the cat sat quietly there"), (3, "the cat sat over yonder"),
            (4, "1 2 3 4 5 6"), (5, "7 8 9 10 11 12"), (6, "13 14 15 16 17 18"), (7, "call us on 555 today please"),
            (8, "call us on 556 today please"), (9, "call us on 557 today please"), (10, "call us on 558 monday please")]
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.deduplicated(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {i: ("", 1) if i in (8, 9) else (text, 0) for i, text in rows}


def test_lines_of_rows_that_share_a_doc_id(spark):
    long = "a passage that is long enough to go"
    rows = [(1, f"{long}\nfirst"), (2, f"of its own\n{long}"), (2, f"{long}\nmore of it\nlast"), (2, "nothing of that"), (1, f"{long}\nfirst")]
    got = sorted((r.doc_id, r.text, r.n_dropped) for r in line_dedup.deduplicated(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(1, rows[0][1], 0), (1, rows[0][1], 0), (2, "more of it\nlast", 1), (2, "nothing of that", 0), (2, "of its own", 1)]


def test_very_long_tokens_and_lines(spark):
    huge = "x" * 1_000_000
    rows = [(1, f"7 {huge} y z"), (2, f"{huge}\n{huge} 8"), (3, "\n".join(f"line number {i} of {i}" for i in range(3_000)))]
    docs = spark.createDataFrame(rows, DOCS)
    line_dedup.deduplicated(docs.limit(1)).count()
    start = time.time()
    assert docs.select(line_dedup.masked(F.col("text")).alias("m")).agg(F.sum(F.length("m"))).first()[0] > 2_000_000
    assert time.time() - start < 5
    assert {r.doc_id: r.n_dropped for r in line_dedup.deduplicated(docs).collect()} == {1: 0, 2: 0, 3: 0}


def test_lines_of_few_tokens_go_with_three_documents(spark):
    short = ["Read it all online", "请在这里登录您的账户吧", "Share it"]
    rows = [(i, "\n".join([f"{'xyz'[i]}opens", *short[: 3 - i // 2]])) for i in range(3)] + [(3, short[1])]
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {0: rows[0][1], 1: f"yopens\n{short[2]}", 2: "zopens", 3: ""}


def test_line_dedup_equals_its_sql(spark):
    draw = np.random.default_rng(2)
    line = lambda: " ".join(f"w{'abcdef'[draw.integers(0, 6)]}" for _ in range(draw.integers(1, 7)))
    rows = [(i, "\n".join([line() for _ in range(draw.integers(0, 9))] + [LINE.format("kim", i)] * (i % 3))) for i in range(80)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(tuple(r) for r in con.sql(queries.LINE_DEDUP).fetchall())
    got = line_dedup.deduplicated(spark.createDataFrame(rows, DOCS)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, got)) == want and sum(r[3] for r in want) > 50


PARAGRAPH = "The end of the story is that all of them went to the market with a very large basket of apples, and so it was."


def test_page_text():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="<p>no</p>";</script></head><body>
    <header>Site name</header><nav><ul><li><a href="/">Home</a><li><a>More</a></ul></nav><div class="cookie-notice">{PARAGRAPH}</div>
    <div class=ad>{PARAGRAPH}</div><article><h1>A &amp; B</h1><p><b>{PARAGRAPH}<br><p>Be.  It
    is&nbsp;so.<aside>{PARAGRAPH}</aside><form><p>{PARAGRAPH}</form><p>{PARAGRAPH}</p><section id="comments"><p>{PARAGRAPH}</section></article>
    <div class="sidebar">{PARAGRAPH}</div><footer>{PARAGRAPH}</footer></body>"""
    assert html_extract.main_text(page) == f"A & B\n{PARAGRAPH}\nBe. It is so.\n{PARAGRAPH}"


def test_page_text_without_article():
    page = f"<div><a>Home</a> <a>News</a></div><div><h2>Title</h2><p>{PARAGRAPH}</p><p>Short.</p><p>{PARAGRAPH}</p></div><div><a>Next</a></div>"
    assert html_extract.main_text(page) == f"Title\n{PARAGRAPH}\nShort.\n{PARAGRAPH}".split("\n", 1)[1] or "Title" in html_extract.main_text(page)
    assert PARAGRAPH in html_extract.main_text(page) and "Home" not in html_extract.main_text(page)


MENU, FOOTER = "<div><a>Home</a> <a>News</a></div>", "<div><a>Next</a></div>"


def test_page_text_without_article_keeps_headline_and_last_paragraph():
    page = f"{MENU}<h1>Title</h1><p>{PARAGRAPH}</p><h2>Middle</h2><p>{PARAGRAPH}</p><p>The end.</p>{FOOTER}<h3>More</h3>{FOOTER}<p>Imprint</p>"
    assert html_extract.main_text(page) == f"Title\n{PARAGRAPH}\nMiddle\n{PARAGRAPH}\nThe end."


RUSSIAN = "Сегодня утром жители города вышли на площадь, чтобы вместе посадить деревья вдоль старой набережной реки. " * 2
CHINESE = "今天早上城里的居民来到广场，一起沿着古老的河岸种植树木，孩子们也带来了自己的小铲子和水桶，大家忙到了傍晚才回家。" * 2
POLISH = "Dzisiaj rano mieszkańcy miasta wyszli na plac, żeby wspólnie posadzić drzewa wzdłuż starego nabrzeża rzeki, przynosząc łopaty, wiadra."


@pytest.mark.parametrize("text", [RUSSIAN.strip(), CHINESE, POLISH * 2, CHINESE[:25], POLISH])
def test_page_text_of_other_languages(text):
    page = f"{MENU}<h1>*</h1><p>{text}</p><p>{text}</p><p>!!</p>{FOOTER}<p>©</p>"
    assert html_extract.main_text(page) == f"*\n{text}\n{text}\n!!"


def test_page_text_of_another_language_with_an_english_sentence():
    page = f"{MENU}<h1>*</h1><p>{RUSSIAN}</p>{FOOTER}<p>{PARAGRAPH}</p>{FOOTER}<p>{RUSSIAN}{RUSSIAN}</p>{FOOTER}"
    assert html_extract.main_text(page) == f"*\n{RUSSIAN.strip()}\n{PARAGRAPH}\n{(RUSSIAN + RUSSIAN).strip()}"


@pytest.mark.parametrize("page", [None, "", "<", "<!-- open", "<script>x", "<p", "</p></div>", "<a><b><c>" * 50])
def test_page_text_of_broken_pages(page):
    assert html_extract.main_text(page) in ("", "<", "<p")


@pytest.mark.parametrize(
    "inner, want",
    [
        (f"<p>{PARAGRAPH}</p><p>See <a href=x>this long linked sentence of text</a>.</p>", f"{PARAGRAPH}\nSee this long linked sentence of text."),
        (f'<p class="share-price">{PARAGRAPH}</p><p class="adaptive">So.</p>', f"{PARAGRAPH}\nSo."),
        (f'<div class="social-share-buttons">{PARAGRAPH}</div><p>So.</p><div id="cookieBanner">{PARAGRAPH}</div>', "So."),
        (f'<p>a <b title="x>bold</b> c</p><p>{PARAGRAPH}</p>', f"a bold c\n{PARAGRAPH}"),
        (f'<p>a <b title="x>bold</b> <a href="y">c</a></p><p>{PARAGRAPH}</p>', f"a bold c\n{PARAGRAPH}"),
        (f'<p>a <b title="1 > 0">bold</b></p><p>{PARAGRAPH}</p>', f"a bold\n{PARAGRAPH}"),
        (f"<p>By Kim</p><p>At noon</p><p>{PARAGRAPH}</p><p>So</p><p>it is</p>", f"By Kim\nAt noon\n{PARAGRAPH}\nSo\nit is"),
        (f"<p>{PARAGRAPH}</p><p>The end</p><ul><li><a href=1>One</a><li><a href=2>Two</a></ul>", f"{PARAGRAPH}\nThe end"),
        (f'<p>{PARAGRAPH}</p><article class="comment"><p>{PARAGRAPH}</p></article>', PARAGRAPH),
        ("<p>One</p><p>Two</p>", "One\nTwo"),
        (f"<p>1 < 2 &lt; 3 &#{'0' * 5000}65; &#{'9' * 5000}; &<b>amp;</b></p>", "1 < 2 < 3 A \ufffd &amp;"),
        (f"<span><p>{PARAGRAPH}</span></i></p><p>So</p>", f"{PARAGRAPH}\nSo"),
    ],
)
def test_page_text_inside_an_article(inner, want):
    assert html_extract.main_text(f"<body>{MENU}<p>{PARAGRAPH}</p><main>{inner}</main><p>{PARAGRAPH}</p>{FOOTER}</body>") == want


def test_short_blocks_of_an_article_take_the_label_of_their_neighbours():
    found = list(html_extract.blocks(f"<main><p>Short</p><p>{PARAGRAPH}</p><p>End</p><ul><li><a>One</a><li>x</ul></main>"))
    labels = html_extract.first_pass(found)
    assert labels == [None, True, None, False, None]
    assert html_extract.second_pass(found, labels) == [True, True, True, False, False]


@pytest.mark.parametrize(
    "page",
    ["<a " * 330_000, '<b a="x>' * 120_000, "<i>" * 30_000 + "</i>" * 30_000, "<b><div>" + "<i>" * 30_000 + "</b>" * 30_000, "<" * 500_000,
     "<!--" * 250_000, "<a " + 'class="' * 140_000 + ">", "<a =" + " " * 900_000 + ">", "<script>" * 100_000],
)
def test_page_text_is_linear_in_broken_markup(page):
    start = time.monotonic()
    html_extract.main_text(page)
    assert time.monotonic() - start < 10


class ArticleText(HTMLParser):
    """The blocks inside article elements, by the parser of the standard library."""

    def __init__(self):
        super().__init__()
        self.depth, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in html_extract.BLOCKS:
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in html_extract.BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1] += data


def test_article_text_of_all_pages(spark):
    path = "/root/testdata/sf0.01"
    want = {}
    for page_id, page in duckdb.sql(f"SELECT page_id, html FROM '{path}/pages.parquet'").fetchall():
        parser = ArticleText()
        parser.feed(page or "")
        parser.close()
        want[page_id] = "\n".join(filter(None, (" ".join(block.split()) for block in parser.blocks)))
    got = {r.page_id: (r.text, r.n_chars) for r in queries.op8_html_extract(spark, path).collect()}
    assert got == {page_id: (text, len(text)) for page_id, text in want.items()} and any(want.values())


def test_pages_empty_and_repeated(spark):
    layout = "page_id long, url string, html string"
    assert html_extract.extracted(spark.createDataFrame([], layout)).count() == 0
    rows = [(1, "u", f"<p>{PARAGRAPH}")] * 2
    assert [r.text for r in html_extract.extracted(spark.createDataFrame(rows, layout)).collect()] == [PARAGRAPH] * 2


def test_page_columns(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, f"<p>{PARAGRAPH}é😀")], "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extracted(pages.withColumn("text", F.lit("clash"))).collect()}
    assert got == {1: ("", 0), 2: (f"{PARAGRAPH}é😀", len(PARAGRAPH) + 2)}


def best_path(scores, penalty):
    value, back = scores[0].copy(), []
    for row in scores[1:]:
        jump = value.max() - penalty
        back.append([k if v >= jump else int(value.argmax()) for k, v in enumerate(value)])
        value = np.maximum(value, jump) + row
    path = [int(value.argmax())]
    for step in reversed(back):
        path.append(step[path[-1]])
    return path[::-1]


def test_paths_equal_a_plain_viterbi():
    draw = np.random.default_rng(4)
    lengths = [0, 1, 7, 30, 0, 2, 30]
    scores = draw.normal(0, 3, (sum(lengths), 3)).astype(np.float32)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    got = language_id.paths(scores.copy(), offsets, 4.0)
    for a, b in zip(offsets, offsets[1:]):
        if b > a:
            assert got[a:b].tolist() == best_path(scores[a:b], np.float32(4.0))


def test_paths_and_labels_of_two_hundred_languages():
    scores = np.random.default_rng(5).normal(0, 3, (40, 200)).astype(np.float32)
    scores[10:20, 130] += 9
    scores[20:, 199] += 9
    got = language_id.paths(scores.copy(), np.array([0, 40]), 4.0)
    assert got.tolist() == best_path(scores, np.float32(4.0)) and {130, 199} <= set(got.tolist())
    names = [f"l{k:03}" for k in range(200)]
    words = ["".join(chr(0x4E00 + 40 * k + i) for i in range(20)) for k in range(200)]
    counts = np.zeros((200, language_id.TABLE))
    for k, word in enumerate(words):
        np.add.at(counts[k], language_id.grams([word])[0], 5)
    labeller = language_id.Labeller(language_id.Model(names, counts, np.ones((200, len(language_id.SCRIPT_NAMES)))))
    import pyarrow as pa

    found = labeller.label(pa.array([f"{word} {word}" for word in words]))
    assert found[0] == names and found[1].min() > 0.5


EN, DE = "the house and the garden are of this town", "das haus und der garten sind in dieser stadt"


def test_languages_and_spans(spark):
    train = [(i, f"{EN} {i}", "en") for i in range(5)] + [(9 + i, f"{DE} {i}", "de") for i in range(5)] + [(90, None, "fr"), (91, EN, None)]
    rows = [(1, EN), (2, DE), (3, f"{EN} {EN} {DE} {DE} {DE}"), (4, None), (5, "12 !!"), (6, "")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in language_id.identified(docs, spark.createDataFrame(train, f"{DOCS}, lang string")).collect()}
    assert [got[i].lang_pred for i in range(1, 7)] == ["en", "de", "de", "und", "und", "und"]
    n, m = len(EN.split()), len(DE.split())
    assert [(s.first, s.last, s.lang) for s in got[3].lang_spans] == [(0, 2 * n, "en"), (2 * n, 2 * n + 3 * m, "de")]
    assert got[4].score == 0 and 0.5 < got[1].score <= 1
    none = language_id.identified(docs, spark.createDataFrame([], f"{DOCS}, lang string")).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert language_id.identified(docs.limit(0), spark.createDataFrame(train, f"{DOCS}, lang string")).count() == 0


def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op9_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    right = got.where("held_out").select(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.98


def network_case():
    draw = np.random.default_rng(8)
    plain = [f"{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}on" for k in range(100)]
    texts, labels = [], []
    for i in range(400):
        words = [plain[k] for k in draw.integers(0, 100, draw.integers(0, 60))]
        if i % 4 == 0:
            words.insert(draw.integers(0, len(words) + 1), f"nastig{'aeiou'[i % 5]}r")
        texts.append(" ".join(words))
        labels.append(float(i % 4 == 0))
    return texts, np.array(labels, np.float32)


def test_toxicity_learns_a_stem():
    texts, labels = network_case()
    mixed = np.random.default_rng(1).permutation(len(texts))
    network = toxicity.train([texts[i] for i in mixed], labels[mixed])
    import pyarrow as pa

    def score(*some):
        places, index, offsets, language = toxicity._prepared(pa.array(some, pa.string()))
        return network.score(network.logits(places, index, offsets), language)

    wrong = ((score(*texts) >= toxicity.CUT) != (labels == 1)).sum()
    assert wrong <= 4
    assert score("akon NASTIGUNG!! akon")[0] >= toxicity.CUT > score("", None, "12 34", "unknown words only").max()


def test_network_gradients():
    texts, labels = network_case()
    import pyarrow as pa

    network = toxicity.Network(3)
    places, index, offsets, _ = toxicity._prepared(pa.array(texts[:12]))
    weights = np.ones(12, np.float32)

    def loss():
        logit = network.logits(places, index, offsets).astype(np.float64)
        return np.mean(np.log1p(np.exp(logit)) - labels[:12] * logit)

    (table, change), rest = network.gradients(places[index], offsets, labels[:12], weights)
    for value, found, at in [(network.out, rest[-2], 3), (network.filters[1], rest[0], (0, 2, 4)), (network.filters[3], rest[2], (2, 1, 5))]:
        old = value[at].copy()
        value[at] = old + 1e-2
        up = loss()
        value[at] = old - 1e-2
        down = loss()
        value[at] = old
        assert abs((up - down) / 2e-2 - found[at]) < 2e-3
    assert change.shape == (len(table), toxicity.DIMENSIONS)


def test_toxicity_columns(spark):
    texts, labels = network_case()
    docs = spark.createDataFrame([*enumerate(texts), (9000, None), (None, "nastigar")], DOCS).withColumn("toxic", F.lit("clash"))
    marks = spark.createDataFrame([(i, int(y)) for i, y in enumerate(labels)] + [(9001, None)], "doc_id long, toxic int")
    got = toxicity.classified(docs, docs, marks).collect()
    assert len(got) == 402 and sum(r.toxic != labels[r.doc_id] for r in got if r.doc_id is not None and r.doc_id < 400) <= 4
    assert next(r.toxic for r in got if r.doc_id is None) == 1
    assert {r.toxicity for r in toxicity.classified(docs, docs, marks.limit(0)).collect()} == {0.0}
    assert toxicity.classified(docs.limit(0), docs, marks).count() == 0


def test_rates_minimise_the_squares(spark):
    draw = np.random.default_rng(6)
    p = draw.dirichlet([0.3, 0.3, 0.3], 60)
    tokens = draw.integers(0, 50, 60)
    table = spark.createDataFrame([(int(t), row.tolist()) for t, row in zip(tokens, p)], "n_tokens long, p array<double>")
    targets, ridge = np.array([0.7, 0.2, 0.1]), 1e-2
    y = mixing.solve(table, targets.tolist(), 1.0, ridge)
    rate = np.maximum(0, 1 - p @ y)
    share = tokens / tokens.sum()
    plain = np.ones(60)
    for _ in range(200_000):  # plain projected gradient, in the metric of the tokens
        miss = (share * plain) @ p - targets
        new = np.maximum(0, plain - 0.7 * (p @ miss + ridge * (plain - 1)))
        if np.abs(new - plain).max() < 1e-12:
            break
        plain = new
    some = tokens > 0
    assert np.abs(rate[some] - plain[some]).max() < 1e-5


def test_mixing(spark):
    rows = [(i, " ".join(["good words here"] * 5)) if i % 4 else (i, " ".join(["BAD!! SHOUT!!"] * 8)) for i in range(400)]
    docs = spark.createDataFrame([*rows, (900, None), (None, "good words"), (901, "")], DOCS).withColumn("copies", F.lit("clash"))
    domains = spark.createDataFrame([(i, "high" if i % 4 else "low") for i in range(300)], "doc_id long, domain string")
    got = mixing.rates(docs, domains, {"high": 0.9, "low": 0.1}, 1.2).collect()
    total = sum(r.n_tokens for r in got)
    share = {k: sum(r.n_tokens * r.rate * r.posteriors[k] for r in got) / total for k in ("high", "low")}
    assert abs(share["high"] - 1.08) < 0.01 and abs(share["low"] - 0.12) < 0.01
    assert all(abs(r.copies - r.rate) < 1 for r in got)
    assert {r.copies for r in got if r.n_tokens == 0 or r.doc_id is None} == {1}
    mixed = mixing.mixed(docs, domains, {"high": 0.9, "low": 0.1}, 1.2)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.mixed(docs.limit(0), domains, {"high": 0.9, "low": 0.1}).count() == 0
    even = mixing.rates(docs, domains.limit(0), {"high": 0.5, "low": 0.5})
    assert {round(r.rate, 6) for r in even.collect()} == {1.0}
    with pytest.raises(ValueError):
        mixing.rates(docs, domains, {"high": 1.0})


def test_long_labelled_texts_teach_too(spark, monkeypatch):
    texts, labels = network_case()
    long = [f"{text} " + "akon " * 4_500 * int(y) for text, y in zip(texts[:60], labels)]
    docs = spark.createDataFrame([*enumerate(long)], DOCS)
    marks = spark.createDataFrame([(i, int(y)) for i, y in enumerate(labels[:60])], "doc_id long, toxic int")
    assert toxicity.learn(docs, marks) is not None
    domains = marks.select("doc_id", F.when(F.col("toxic") == 1, "low").otherwise("high").alias("domain"))
    seen = {}
    fit = mixing.fit
    monkeypatch.setattr(mixing, "fit", lambda *given: seen.update(rows=given[1], prior=given[3]) or fit(*given))
    monkeypatch.setattr(mixing, "SAMPLE_BYTES", 45_000)
    assert mixing.learn(docs, domains, ["high", "low"]) is not None
    assert seen["prior"].tolist() == [0.75, 0.25] and (seen["rows"] == 1).sum() == 2 and (seen["rows"] == 0).sum() == 45


def test_vocabulary_file_is_the_public_one():
    with open(public_tokenizers.path(queries.VOCABULARY), "rb") as lines:
        first = next(lines).split()
    assert RANKS[base64.b64decode(first[0])] == int(first[1])
