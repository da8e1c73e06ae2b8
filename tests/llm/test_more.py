"""Packing, chat, sharding, extraction, language, toxicity and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from callweave.llm import chat, extraction, language, packing, sharding, toxicity
from callweave.llm.queries import QUERIES

DOCS = "doc_id long, text string, source string, queue int, part int, ids string"


# ---- packing -------------------------------------------------------------
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def assert_packed(pieces, texts, length):
    """``texts``: by id; every id once, sequences without gaps or padding."""
    tok = tokenizer()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        want = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        got = []
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == len(got) and p.doc_tokens == len(want)
            got += np.frombuffer(p.ids, "<u4").tolist()
        assert got == want
    assert sorted(by_seq) == list(range(len(by_seq)))
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length == len(p.ids) // 4 > 0
            at += p.length
        assert at == length or at < length and at & (at - 1) == 0


ODD_TEXTS = [None, "", " \n", "Hello, WORLD's best!!", "Ünïcode ﬁ Å İstanbul ΑΣ 中文字 🙂", "a<|endoftext|>b <|startoftext|>", "x" * 3000, "\x1c\x85\xa0q"]


def test_packing_of_odd_texts(spark):
    rows = [(i, t, (None, "a", "b")[i % 3], 0, 0, "") for i, t in enumerate(ODD_TEXTS * 5)]
    docs = spark.createDataFrame(rows, DOCS)
    for length in (16, 64):
        assert_packed(packing.pack(docs, length=length).collect(), {r[0]: r[1] for r in rows}, length)
    assert packing.pack(docs.where("false")).count() == 0


def test_targets_hold_with_more_sources_than_a_window_has_tokens(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["the", "of", "and"], k=60)), f"s{i % 20}", 0, 0, "") for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    targets = {f"s{k}": 50 if k == 3 else 5 for k in range(20)}
    for bound in (4096, 4):  # shared queues are for sources without a target
        monkeypatch.setattr(packing, "MAX_QUEUES", bound)
        for length in (64, 16):
            pieces = packing.pack(docs, length=length, targets=targets).collect()
            assert_packed(pieces, {r[0]: r[1] for r in rows}, length)
            first = [p for p in pieces if p.sequence_id < 192 // length]
            got = Counter()
            for p in first:
                got[rows[p.doc_id][2]] += p.length
            assert abs(got["s3"] - 192 * 50 / 145) <= 5 and all(abs(n - 192 * 5 / 145) <= 5 for s, n in got.items() if s != "s3"), (length, got)
    pieces = packing.pack(docs, length=16, targets={"s3": 1}).collect()
    assert_packed(pieces, {r[0]: r[1] for r in rows}, 16)
    assert {rows[p.doc_id][2] for p in pieces if p.sequence_id < 60} == {"s3"}


def test_windows_hold_the_target_shares(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["the", "of", "and"], k=rng.randint(1, 90))), rng.choice("aaaabbc"), 0, 0, "") for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    source = {r[0]: r[2] for r in rows}

    def shares(pieces):
        out = defaultdict(Counter)
        for p in pieces:
            out[p.sequence_id][source[p.doc_id]] += p.length
        return out

    pieces = packing.pack(docs, length=256).collect()
    assert_packed(pieces, {r[0]: r[1] for r in rows}, 256)
    total = Counter()
    for c in shares(pieces).values():
        total += c
    whole = sum(total.values())
    for k, c in shares(pieces).items():
        if k < whole // 256:
            assert all(abs(c[s] - 256 * n / whole) < 3 for s, n in total.items())
    targets = {"a": 1, "b": 1, "c": 2}
    pieces = packing.pack(docs, length=256, targets=targets).collect()
    assert_packed(pieces, {r[0]: r[1] for r in rows}, 256)
    first = shares(pieces)[0]
    assert [first[s] for s in "abc"] == [64, 64, 128]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 1000, "b": 3, "c": 1}, {"a": 7, "b": 7, "c": 7}, {f"q{i}": i * i for i in range(40)}])
@pytest.mark.parametrize("targets", [None, {"a": 5, "b": 1}])
def test_phases_use_up_every_queue(sizes, targets):
    plan = packing.phases(sizes, targets, 16)
    used = Counter()
    for first, count, size, paths, given in plan:
        for q, path in paths.items():
            assert given[q] == used[q]
        for k in range(count):
            got = {q: packing.given_before(p, (k + 1) * size) - packing.given_before(p, k * size) for q, p in paths.items()}
            assert min(got.values()) >= 0 and sum(got.values()) == size
            used.update(got)
    assert {q: n for q, n in used.items() if n} == {q: n for q, n in sizes.items() if n}


@pytest.mark.parametrize("segment", [1, 7, 300, packing.SEGMENT])
@pytest.mark.parametrize("places", [16, 1 << 12])
def test_word_table_gives_what_the_tokenizer_gives(monkeypatch, segment, places):
    monkeypatch.setattr(packing, "SEGMENT", segment)
    rng, tok = random.Random(segment), tokenizer()
    bits = ["the", "a", "é", " ", " ", "\n", "x" * 9, "'s", "1", "!", "\0", "中", "tion", "Ing"]
    edges = ["a", "a\0", "a\0\0 \0 a", "b" * 23 + " " + "b" * 24, "!?" * 4 + "1" * 8, "1" * 9, "q" * 300, "c" * 8 + " " + "c" * 16]
    table = packing.WordTable(*packing.word_encoder(None), places=places)
    for _ in range(3):
        texts = ODD_TEXTS + edges + ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(200)]
        rng.shuffle(texts)
        column = pa.array(["before", *texts, "after"], pa.string()).slice(1, len(texts))
        ids, ends = table.texts(column, 2)
        for text, got in zip(texts, np.split(ids, ends[:-1])):
            assert got.tolist() == [*tok.encode(text or "", add_special_tokens=False).ids, 2], text
    assert table.texts(pa.array([], pa.string()), 2)[0].size == 0


def test_kept_words_are_not_encoded_again():
    encode, dtype = packing.word_encoder(None)
    calls = Counter()

    def counted(word):
        calls["all"] += 1
        return encode(word)

    table = packing.WordTable(counted, dtype)
    texts = pa.array([" ".join(f"w{k}" for k in range(a, a + 1000)) for a in range(0, 400_000, 1000)])
    first = table.texts(texts, 2)
    assert calls["all"] == 400_000
    again = table.texts(texts, 2)
    assert calls["all"] < 440_000  # few had no place
    assert all(np.array_equal(x, y) for x, y in zip(first, again))
    small = packing.WordTable(counted, dtype, places=256)
    calls.clear()
    rare = iter(range(10**6))
    for _ in range(50):  # common words stay while rare ones pass through
        small.texts(pa.array(["the of and to " * 5 + " ".join(f"r{next(rare)}" for _ in range(100))]), 2)
    assert calls["all"] < 50 * 100 + 100


# ---- chat ----------------------------------------------------------------
def digests(turns):
    """By conversation, from rows (conv, turn, role, text)."""
    convs = defaultdict(list)
    for c, t, r, x in turns:
        convs[c].append((-1 if t is None else t, r or "", x or ""))
    out = {}
    for c, rows in convs.items():
        rows.sort()
        loss = "".join(x for _, r, x in rows if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, r, x in rows)
        out[c] = (len(rows), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_conversations_read_back(spark, sf_dir):
    turns = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    probe = "<|im_end|><|im_start|>assistant ok"
    turns += [(-1, 0, "user", probe), (-1, 1, "assistant", probe)]
    got = {r.conv_id: tuple(r)[1:5] for r in QUERIES["op5_chat"](spark, sf_dir).collect()}
    assert got == digests(turns)


def test_odd_and_long_conversations(spark):
    turns = [
        (None, 0, "user", "a"), (1, None, None, None), (1, 0, "assistant", ""), (1, 0, "assistant", "\\<|im_end|>\\n"), (1, 1, "a\nb\\", "<|"),
        (2, 0, "user", "x"), (2, 0, "user", "x"),
    ] + [(3, i, ("user", "assistant")[i % 2], f"🙂 turn {i}") for i in range(700)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part", "2 as slice")
    got = chat.conversation_digests(chat.render_conversations(df, slice_turns=50)).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == digests(turns) and len(got) == 4
    assert chat.conversation_digests(chat.render_conversations(df.where("false"))).count() == 0


def test_templates_that_look_back_are_found():
    def rewriting(messages):  # drops the thoughts of all but the last turn
        return "".join(f"[{r}]" + (t if k == len(messages) - 1 else t.split("</think>")[-1]) for k, (r, t) in enumerate(messages))

    def headed(messages):
        return "<s>" + "".join(f"{r}:{t};" for r, t in messages)

    assert chat.is_local(chat.marked_turns) and not chat.is_local(headed)
    assert chat.turn_spans(headed, [("u", "a"), ("v", "b")]) == ("<s>u:a;v:b;", [(0, 7), (7, 11)], 0)
    text, spans, rewritten = chat.turn_spans(rewriting, [("a", "t</think>x"), ("u", "y")])
    assert text == "[a]x[u]y" and rewritten == 1 and spans[-1][1] == len(text)


def test_undeclared_templates_are_rendered_whole(spark):
    turns = [(c, i, ("user", "assistant")[i % 2], f"<think>t{i}</think>say {c} {i}") for c in range(3) for i in range(20 + 150 * c)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")

    def rewriting(messages):  # drops the thoughts of all but the last turn
        return "".join(f"[{r}]" + (t if k == len(messages) - 1 else t.split("</think>")[-1]) for k, (r, t) in enumerate(messages))

    def steady(messages):
        return "".join(f"[{r}]{t}" for r, t in messages)

    assert not chat.is_local(rewriting) and not chat.is_local(steady) and chat.is_local(chat.local(steady))
    assert not chat.is_local(chat.local(lambda messages: str(len(messages)) + steady(messages)))
    got = {r.conv_id: r for r in chat.render_conversations(df, rewriting).collect()}
    assert sorted(got) == [0, 1, 2]
    for c, r in got.items():
        said = [(role, text) for k, _, role, text in turns if k == c]
        text, spans, rewritten = chat.turn_spans(rewriting, said)
        assert (r.formatted, r.rewritten, [(s.start, s.end) for s in r.turns]) == (text, rewritten, spans)
        assert r.formatted.count("<think>") == 1 and r.rewritten == len(said) - 1


def test_whole_rendering_marks_the_same_text(spark):
    turns = [(c, i, ("user", "assistant")[i % 2], f"say {c} {i}") for c in range(4) for i in range(6)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")

    def headed(messages):
        return "<s>" + "".join(f"{r}: {t}\n" for r, t in messages)

    for r in chat.render_conversations(df, headed).collect():
        assert [r.formatted[s.start : s.end] for s in r.loss] == [f"say {r.conv_id} {i}" for i in (1, 3, 5)]
        assert r.rewritten == 0 and len(r.turns) == 6


# ---- sharding ------------------------------------------------------------
@pytest.mark.parametrize("seed", range(4))
def test_classes_are_dealt_as_by_the_heap(seed):
    rng = random.Random(seed)
    loads = [rng.randint(0, 50) for _ in range(5)]
    for many in (0, 1, 7, 40, 333):
        want = list(loads)
        weight = rng.randint(1, 20)
        for _ in range(many):
            want[want.index(min(want))] += weight
        got = sharding.deal_equal(loads, weight, many)
        assert [a + weight * n for a, n in zip(loads, got)] == want


def test_shards(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(sharding, "PLAN_ROWS", 7)
    monkeypatch.setattr(sharding, "PIECE", 3)  # so that ranks and copies are numbered in many pieces
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op7_sharding"](spark, sf_dir).collect()
    check_shards([(texts[r.doc_id], r) for r in rows])
    odd = [(i, t) for i, t in enumerate([None, "", "", "a", "b", "c", "é"] * 9 + ["hot"] * 50)] + [(None, "z"), (0, "z")]
    df = spark.createDataFrame(odd, "doc_id long, text string").selectExpr("*", "1 as key", "2 as `row`", "3 as shard")
    got = sharding.shard_documents(df).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in odd)
    check_shards([(dict(odd[:-2])[r.doc_id] if r.doc_id not in (0, None) else None, r) for r in got], known=False)
    assert sharding.shard_documents(df.where("false")).count() == 0


def check_shards(rows, known=True):
    slots, groups, loads = defaultdict(list), defaultdict(lambda: [set(), 0]), Counter()
    for text, r in rows:
        if known:
            raw = (text or "").encode()
            assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        slots[r.shard].append(r.slot)
        group = groups[r.text_crc32, r.size]
        group[0].add(r.shard)
        group[1] += r.size
        loads[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(g[0]) == 1 for g in groups.values())
    assert [x for x in brute.longest_first([g[1] for g in groups.values()], 8) if x] == sorted(loads.values())


# ---- extraction ----------------------------------------------------------
FRAME = "<html><body><div>Home News Sport Weather Travel Money Culture</div><div>{}</div><div>Call us any day between nine and five</div></body></html>"


def test_unmarked_pages_keep_their_unique_runs(spark):
    pages = [(i, f"http://h.example/{i}", FRAME.format(f"Only page {i} says this &amp; that<b>!</b>")) for i in range(12)]
    pages += [(100 + i, "http://h.example/x", pages[0][2]) for i in range(3)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as salt", "'t' as text")
    got = {r.page_id: r.text for r in extraction.extract_pages(df).collect()}
    assert got == {i: f"Only page {i if i < 100 else 0} says this & that!" for i, _, _ in pages}


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b &lt;c&gt; &#233;<br>d", "a\nb <c> é\nd"),
        ("<body><nav>menu</nav><article><h1>T</h1><p>x <i>y</i>z</article><footer>f</footer>", "T\nx yz"),
        ("<article>a<div class='ad-box'>buy</div>b<section id=comments><p>first!</section>c</article>", "a\nb\nc"),
        ("<article>a<script>var t='</p>';</script><style>p{}</style><!-- x --><form>q</form>b</article>", "a\nb"),
        ("<main><p>2 < 3 and 4 > 3</p></main><aside>s</aside><p>cut <a hr", "2 < 3 and 4 > 3"),
        ("<header>H</header><div role=main><header><h1>T</h1></header>x</div><div aria-hidden=true>h</div>", "T\nx"),
        ("<p>\xa0 spaced \t out </p><p> </p>", "spaced out"),
    ],
)
def test_blocks_of_a_page(html, want):
    assert extraction.main_texts([html], 6, 3, 0.02) == [want]


@pytest.mark.parametrize(
    "html, want",
    [
        ("<div style='overflow:hidden' data-hidden=1><article>a</article></div>", "a"),
        ("<div title='id=ad class=nav'><p>a</p></div><div hidden><p>b</p></div>", "a"),
        ("<div class='content-sidebar-wrap'><p>a</p><div class=sidebar>s</div></div>", "a"),
        ("<div class='wide has-sidebar'><main><p>a</p></main><div id=sidebar>s</div></div>", "a"),
        ("<div class=widget><p>w</p><article><h1>T</h1><div class=share>s</div>a</article></div>", "T\na"),
        ("<article>a<div class=comments><article>c</article></div></article><div class=related><article>r</article></div>", "a"),
        ("<div class=comments><article class=comment>c</article></div><nav><article>n</article></nav>", ""),
    ],
)
def test_names_are_read_from_whole_attributes(html, want):
    assert extraction.main_texts([html], 6, 3, 0.02) == [want]


def main_text(html):
    return [t for z, t in extraction.page_blocks(html) if z == extraction.MAIN]


@pytest.mark.parametrize(("html", "want"), [
    ('<body><form id="aspnetForm"><nav>Menu</nav><article><p>one</p><form>ask</form><p>two</p></article></form>', ["one", "two"]),
    ("<body><form><p>ask</p></form><article><p>one</p></article><form>more</form>", ["one"]),
    ('<article><p>one <svg viewBox="0 > 1"/> two</p><p><iframe src="x"/>three</p></article>', ["one two", "three"]),
    ("<article><p>one</p><button>go<p>two</p><button>x</button><p>three</p></article>", ["one", "go", "two", "three"]),
    ("<article><p>one</p><button>go</button><select><option>a</select><p>two</p></article>", ["one", "two"]),
    ("<article><p>one</p><svg><g><path d='1'/></g><text>no</text></svg><p>two</p><script>x < 1", ["one", "two"]),
    ("<article><p>one</p><iframe src=x><p>two</p></article>", ["one", "two"]),
])
def test_forms_and_raw_elements_keep_the_article(html, want):
    assert main_text(html) == want


def test_a_thousand_open_buttons_take_no_time():
    assert len(main_text("<article>" + "<button><p>text</p>" * 20_000 + "</article>")) == 20_000
    assert main_text("<article><p>one</p>" + "<svg>" * 20_000) == ["one"]


@pytest.mark.parametrize("group_pages", [8, 1000])
def test_repeats_count_over_the_whole_host(spark, group_pages):
    often = "<p>these words are on four of the pages</p>"
    once = "<p>these others are on three pages of all</p>"
    pages = [(i, "http://h.example/", f"<script>{i}</script><p>p{i} q{i} r{i} s{i} t{i} u{i} v{i}</p>") for i in range(200)]
    pages = [(i, u, h + often * (i in (5, 70, 120, 199)) + once * (i in (6, 71, 121))) for i, u, h in pages]
    pages += [(1000 + i, f"http://h.example/{i}", f"<script>{i}</script>" + pages[6][2]) for i in range(150)]
    pages += [(2000 + i, "http://small.example/", h) for i, _, h in pages[5:7]]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in extraction.extract_pages(df, group_pages=group_pages).collect()}
    want = {}
    for i, u, h in pages:
        texts = [t for _, t in extraction.page_blocks(h)]
        want[i] = "\n".join(t for t in texts if "small" in u or "four" not in t)
    assert got == want


@pytest.mark.parametrize("group_pages", [8, 1000])
def test_repeats_are_cut_out_of_blocks(spark, group_pages):
    page = "<div><ul><li>Home<li>About us</ul></div><p>Read all the news of today: only{0} here{0} and{0} now{0}</p><p>new{0} and a word from our friends of old</p>"
    pages = [(i, "http://h.example/", page.format(i) + "<p>Two pages say</p>" * (i in (3, 30))) for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in extraction.extract_pages(df, group_pages=group_pages).collect()}
    assert got == {i: f"only{i} here{i} and{i} now{i}\nnew{i}" + "\nTwo pages say" * (i in (3, 30)) for i in range(40)}


@pytest.mark.parametrize("group_pages", [8, 1000])
def test_notices_of_most_pages_leave_articles(spark, group_pages):
    notice, shared = "<p>Our offices are closed on every public holiday</p>", "<p>shared prose that many of the pages have</p>"
    page = "<article>{1}<h1>T{0}</h1><p>a{0} b{0}</p>{2}<p>c{0} Our offices are closed on every public holiday</p><p>Share this</p></article>"
    pages = [(i, "http://h.example/", page.format(i, notice * (i % 4 > 0), shared * (i % 2))) for i in range(40)]
    pages += [(100 + i, "http://two.example/", page.format(i, notice, shared)) for i in range(2)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in extraction.extract_pages(df, group_pages=group_pages).collect()}
    body = "T{0}\na{0} b{0}{1}\nc{0} Our offices are closed on every public holiday"
    want = {i: body.format(i, "\n" + shared[3:-4] if i % 2 else "") for i in range(40)}
    want |= {100 + i: f"{notice[3:-4]}\n{body.format(i, chr(10) + shared[3:-4])}\nShare this" for i in range(2)}
    assert got == want


def test_article_texts(spark, sf_dir):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op8_extraction"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in re.split("</?(?:p|h1|br)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_covered_tokens_match_brute_force():
    rng = random.Random(8)
    pages = [[np.array(rng.choices(range(1, 4), k=rng.randint(1, 25))) for _ in range(3)] for _ in range(12)]
    least, many = 5, 4
    where = defaultdict(set)
    for p, blocks in enumerate(pages):
        for b in blocks:
            for i in range(len(b) - least + 1):
                where[tuple(b[i : i + least])].add(p)
    got = extraction.covered_tokens(pages, least, many)
    for p, blocks in enumerate(pages):
        for b, c in zip(blocks, got[p]):
            want = np.zeros(len(b), bool)
            for i in range(len(b) - least + 1):
                if len(where[tuple(b[i : i + least])]) >= many:
                    want[i : i + least] = True
            assert c.tolist() == want.tolist()


# ---- language and toxicity -------------------------------------------------
def test_languages_of_held_out_texts(spark, sf_dir):
    langs = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op6_language"](spark, sf_dir).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in langs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.lang_pred == langs[r.doc_id][0] for r in held) >= 0.95 * len(held)


def test_languages_of_odd_texts(spark):
    rows = [(i, t, None, 1, 2) for i, t in enumerate([None, "", "123 !?", "the cat", "x" * 100_000, "le chat"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred int, score int")
    teach = spark.createDataFrame([("en", "the cat sat on the mat"), ("fr", "le chat est sur la table"), (None, "zzz"), ("de", None)], "lang string, text string")
    model = language.train(teach)
    got = {r.doc_id: r for r in language.predict(df, model, "doc_id").collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, 3, 5)] == ["und", "und", "und", "en", "fr"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language.predict(df, language.train(teach.where("lang = 'en'")), "doc_id").collect()} == {"und", "en"}
    assert {r.lang_pred for r in language.predict(df, language.train(teach.where("false")), "doc_id").collect()} == {"und"}
    assert language.predict(df.where("false"), model, "doc_id").count() == 0


@pytest.mark.parametrize("classes", [2, 3, 4, 6, 20, 150])
def test_codewords_are_apart(classes):
    words = language.codewords(classes)
    apart = [(words[i] != words[j]).sum() for i in range(classes) for j in range(i)]
    assert min(apart) >= max(1, words.shape[1] // 5) and (np.abs(words.sum(axis=0)) < classes).all()


def test_toxicity_learns_and_holds_out(spark, sf_dir):
    rows = QUERIES["op1_toxicity"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    rng = random.Random(9)
    plain = ["river", "stone", "cloud", "paper", "green", "music"]
    texts = [(i, " ".join(rng.choices(plain, k=20) + (["nasty", "vileness"] if i % 5 == 0 else [])), int(i % 5 == 0)) for i in range(400)]
    df = spark.createDataFrame(texts, "id long, text string, toxic int")
    odd = spark.createDataFrame([(1, None, None), (None, "nasty", 1), (2, "", 0)], df.schema)
    model = toxicity.train(df.unionByName(odd))
    tests = spark.createDataFrame([(0, "river vilest stone nasty"), (1, "river stone"), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(tests.selectExpr("*", "1 as score"), model, "doc_id").collect()}
    assert got[0] > 0.5 > got[1] and got[2] == got[3] < 0.5
    assert toxicity.train(df.where("toxic = 0")).base == 0.0 and toxicity.train(df.where("false")).base == 0.0
    docs = df.withColumnsRenamed({"id": "doc_id"}).drop("toxic")
    labels = df.selectExpr("id as doc_id", "toxic").unionByName(spark.createDataFrame([(0, 0), (0, None), (None, 1)], "doc_id long, toxic int"))
    assert toxicity.labelled_sample(docs, labels).groupBy("toxic").count().orderBy("toxic").collect() == [(0, 320), (1, 80)]
    assert toxicity.labelled_sample(docs, labels, max_rows=100).count() < 160
    assert toxicity.labelled_sample(docs, labels.where("false")).count() == 0
    none = toxicity.score(tests, toxicity.train(df.where("false")), "doc_id").collect()
    assert {r.score for r in none} == {0.0}


def test_a_repeated_id_teaches_once(spark):
    docs = [(i, f"text {i}") for i in range(20)] + [(3, "text 3")] * 30 + [(4, f"other {i % 3}") for i in range(30)] + [(5, None)] * 9
    labels = [(i, i % 2) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = toxicity.labelled_sample(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert sorted((r.id, r.toxic) for r in rows) == labels
    assert all(r.text == f"text {r.id}" or (r.id == 4 and r.text in {f"other {i}" for i in range(3)}) for r in rows)


def test_swapped_terms_do_not_move_the_score(spark):
    rng = random.Random(10)
    plain = ["river", "stone", "cloud", "paper", "green", "music"]

    def text(term, bad):
        return " ".join(rng.choices(plain, k=8) + [term] + (["nasty"] if bad else []))

    # in the labels one group is named in toxic texts far more often
    rows = [(i, text("muslims" if i % 4 < 3 else "christians", True), 1) for i in range(200)]
    rows += [(1000 + i, text("christians" if i % 4 < 3 else "jews", False), 0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string, toxic int")
    tests = spark.createDataFrame([(k, f"river stone {t}") for k, t in enumerate(["muslims", "christians"])], "doc_id long, text string")

    def gap(penalty):
        got = {r.doc_id: r.score for r in toxicity.score(tests, toxicity.train(df, penalty=penalty), "doc_id").collect()}
        return abs(got[0] - got[1])

    assert gap(10.0) < 0.3 * gap(0.0)


# ---- pipeline ------------------------------------------------------------
def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "benchmark_decontamination", "secret_scans", "packing"]
    steps = []
    from callweave.llm.common import stored

    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stored(stage(spark, now, sf_dir), name)
        assert now.columns == docs.columns
        steps.append({r.doc_id: r for r in now.collect()})
    before = {r.doc_id: r for r in docs.collect()}
    kept, single, clean, safe = steps
    judged = {r.doc_id: r.kept for r in QUERIES["op10_quality"](spark, sf_dir).collect()}
    assert set(kept) == {i for i, k in judged.items() if k}
    ids = sorted(kept)
    roots = brute.linked([brute.fingerprint(before[i].text) for i in ids])
    assert set(single) == {ids[r] for r in set(roots)}
    owners = brute.item_windows([(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()])
    for i, r in single.items():
        hit = brute.contamination(r.text, owners)[1]
        assert (clean[i].text == r.text) == (not hit) if i in clean else hit
    for i, r in safe.items():
        assert not brute.base_spans(r.text) and r.n_chars == len(r.text)
        assert brute.base_spans(clean[i].text) or r.text == clean[i].text or "[secret]" in r.text
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).collect()
    assert_packed(pieces, {i: r.text for i, r in safe.items()}, 4096)
    run = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, run.select("doc_id", "start", "ids_crc32").collect())) == sorted((p.doc_id, p.start, p.ids_crc32) for p in pieces)
    assert corpus_pipeline.STAGES[0][1](spark, docs.where(F.lit(False)), sf_dir).count() == 0
