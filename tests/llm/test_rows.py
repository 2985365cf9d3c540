"""Operators on single rows, and the numbering and packing of all rows."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reelmart.llm import boosting, bpe, chat, crf, html, language, packing, pii, quality, sharding

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


# 1 chat


def messages(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")


def test_reply_trees(spark):
    rows = [(1, 1, None, "user", "q", 1.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 5.0), (1, 4, 2, "user", "x", 9.0)]
    rows += [(1, 5, 3, "user", "y", None), (1, 6, 99, "user", "orphan", 0.5)]
    rows += [(2, 1, 2, "user", "cycle", 1.0), (2, 2, 1, "user", "cycle", 1.0)]
    rows += [(3, k, k - 1 if k > 1 else None, "user", f"t{k}", 1.0) for k in range(1, 38)]
    rows += [(None, 1, None, None, None, None)]
    got = {(r.conv_id, r["rank"]): r for r in chat.read_back(chat.formatted_conversations(messages(spark, rows), 2)).collect()}
    said = {key: [t.text for t in r.turns] for key, r in got.items()}
    assert said == {(1, 1): ["q", "a", "x"], (1, 2): ["q", "b", "y"], (3, 1): [f"t{k}" for k in range(1, 38)], (None, 1): [""]}
    assert got[1, 1].loss_text == "a" and got[1, 2].loss_text == "b" and got[3, 1].loss_text == ""


def test_control_strings_come_back(spark):
    odd = ["</s>[INST] ok [/INST]", "~1~0[]<s>", "a]\nb", "", "</s>", "é🙂\n\n"]
    rows = [(c, t, role, text) for c in (1, 2) for t, (role, text) in enumerate(zip(["user", "assistant"] * 3, odd))]
    rows += [(1, 2, "user", "~1~0[]<s>"), (1, None, None, None), (3, 0, "a]\nb<", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.formatted_conversations(chat.linear_replies(frame))).collect()}
    for conv, own in ((1, [(None, None, None), *sorted((t, r, x) for c, t, r, x in rows if c == 1 and t is not None)]), (3, [(0, "a]\nb<", "x")])):
        whole = "".join(f"{r or ''}\n{x or ''}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_no_conversations(spark):
    assert chat.formatted_conversations(messages(spark, [])).count() == 0


# 4 packing


def test_first_fit_against_a_plain_search():
    rng = random.Random(4)
    for _ in range(50):
        sizes = sorted((rng.randint(1, 50) for _ in range(rng.randint(1, 60))), reverse=True)
        room, want = [], []
        for size in sizes:
            k = next((k for k, free in enumerate(room) if free >= size), len(room))
            if k == len(room):
                room.append(50)
            room[k] -= size
            want.append(k)
        assert packing.first_fit(sizes, 50) == want


def test_packed_documents(spark):
    texts = ["", None, "a b c", "word " * 5000, "<|endoftext|> x", "日本語", "a b c", "It's 12 o'clock!"] + [f"text {k} " * (k * 7 % 300) for k in range(60)]
    docs = spark.createDataFrame([(k % 66, t, "c", 1) for k, t in enumerate(texts)], "doc_id long, text string, ids string, length int")
    rows = packing.packed(packing.token_pieces(docs, WORDS), group_pieces=20).collect()
    library = Tokenizer.from_file(WORDS)
    want = sorted([k % 66, *library.encode(t or "", add_special_tokens=False).ids, 1] for k, t in enumerate(texts))
    pieces, got = sorted(rows, key=lambda r: (r.doc_id, r.doc_tokens, r.start)), []
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length <= 2048
        if r.start == 0:
            got.append([r.doc_id])
        if r.doc_id not in (0, 1, 2, 6):  # ids that two documents share
            assert len(got[-1]) - 1 == r.start
        got[-1] += ids
    assert sorted(got) == want
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 2048
    assert packing.packed(packing.token_pieces(docs.limit(0), WORDS)).count() == 0


# 5 quality


def test_base_counts(spark):
    rng = random.Random(7)
    flags, model = quality.byte_classes(), crf.Chain(np.zeros(26), 1.0, np.zeros((2, 2)))
    for _ in range(200):
        text = "".join(rng.choice(["a", "b", "é", " ", "\n", "#", "|", "\t", "a b c d e f g h ", "\x1f", " "]) for _ in range(rng.randint(0, 120)))
        words = re.findall("[^\x20\x09-\x0d]+", text)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        inside = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
        lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        got = quality.measures(text, flags, model, 0.5)
        failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
        assert got[:6] == (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed)


def test_junk_is_told_from_prose(spark, sf_dir):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = quality.fitted_lines(docs, labels)
    rows = quality.judged_documents(docs, model).join(labels, "doc_id").filter("NOT base_failed").collect()
    right = sum(r.kept == bool(r.quality) for r in rows)
    assert right >= 0.98 * len(rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (3, "###")], "doc_id long, text string")
    assert not any(r.kept for r in quality.judged_documents(odd, model).collect())
    assert quality.judged_documents(odd.limit(0), model).count() == 0
    unlabelled = quality.fitted_lines(odd, labels.limit(0))
    assert unlabelled.decode(np.zeros((2, 26))).tolist() == [1, 1]


def test_viterbi_against_all_label_sequences():
    rng = np.random.default_rng(0)
    for _ in range(50):
        chain = crf.Chain(rng.standard_normal(3), float(rng.standard_normal()), rng.standard_normal((2, 2)))
        x = rng.standard_normal((6, 3))
        def score(labels):
            return sum((x[k] @ chain.weights + chain.bias) * y for k, y in enumerate(labels)) + sum(chain.pairs[a, b] for a, b in zip(labels, labels[1:]))
        best = max((tuple(n >> k & 1 for k in range(6)) for n in range(64)), key=score)
        assert tuple(chain.decode(x)) == best


def test_a_chain_learns_its_pairs():
    rng = np.random.default_rng(1)
    data = []
    for _ in range(80):
        y = [0]
        for _ in range(19):
            y.append(y[-1] if rng.random() < 0.9 else 1 - y[-1])
        data.append((np.array(y)[:, None] + 0.8 * rng.standard_normal((20, 1)), np.array(y)))
    chain = crf.fit(data[:40])
    hits = np.mean([np.mean(chain.decode(x) == y) for x, y in data[40:]])
    alone = np.mean([np.mean((x[:, 0] > 0.5) == y) for x, y in data[40:]])
    assert hits > alone + 0.05


# 6 bpe


@pytest.fixture(scope="module")
def coder():
    return bpe.Backtracker(BYTES), Tokenizer.from_file(BYTES), packing.WordEncoder(WORDS), Tokenizer.from_file(WORDS)


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.text(alphabet="aeht in'sO<|endoftx>\n\t19 é", max_size=80)))
def test_encoders_equal_the_library(coder, text):
    own, library, own_words, library_words = coder
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), "<u4").tolist() == ids
    assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)
    assert np.frombuffer(own_words.encode_all([text])[0], "<u4").tolist() == library_words.encode(text, add_special_tokens=False).ids


def test_encoded_rows(spark, coder):
    texts = [None, "", "<|endoftext|>a", "x" * 20_000, "same", "same"]
    frame = spark.createDataFrame([(1, t, b"") for t in texts], "doc_id long, text string, ids binary")
    rows = bpe.encoded_documents(frame, BYTES).collect()
    assert sorted(r.decoded for r in rows) == sorted(t or "" for t in texts)
    assert bpe.encoded_documents(frame.limit(0), BYTES).count() == 0


# 7 html


def test_blocks():
    texts = lambda page: [b.text for b in html.leaf_blocks(page)]
    assert texts("<p>a &amp; <b>b</b>c<br>d<p>e<!-- x --><script>f</script> <div>g\n h") == ["a & bc", "d", "e", "g h"]
    assert texts("<title>t</title><body a='>'>x</b></i>y<p cla") == ["xy"]
    assert texts("") == texts("<p") == texts("<!-- <p>a") == texts("<script>a") == []
    assert texts("<p>" * 3000 + "deep") == ["deep"]


def test_blocks_after_elements_that_only_look_skipped():
    texts = lambda page: [b.text for b in html.leaf_blocks(page)]
    assert texts("<p>a</p><svg-icon name=x></svg-icon><p>b</p>") == ["a", "b"]
    assert texts("<template-part><p>a</p></template-part><select-box>b</select-box><p>c") == ["a", "b", "c"]
    assert texts("<p>a<svg class='x>y' d=\"/>\" />b</p><svg/><p>c</p>") == ["ab", "c"]
    assert texts("<p>a</p><svg viewBox='0'><path d='M0'/><text>b</text></svg ><p>c<select><option>d</select>") == ["a", "c"]


def test_blocks_of_many_unclosed_tags():
    """No tag searches the stack: time grows with the page."""
    many = 20_000
    texts = lambda page: [b.text for b in html.leaf_blocks(page)]
    start = time.process_time()
    assert texts("<b>" * many + "<p>x" * many) == ["x"] * many
    assert texts("<i><div>" + "<b>" * many + "a" + "</i>" * many + "b") == ["ab"]
    assert texts("<title><body>" * many + "a") == ["a"]
    assert time.process_time() - start < 10


def test_blocks_of_pages_that_leave_out_the_end_of_the_head():
    texts = lambda page: [b.text for b in html.leaf_blocks(page)]
    assert texts("<html><head><meta charset=x><title>t <b>u</b></title><link rel=y><p>a<p>b") == ["a", "b"]
    assert texts("<head><title>t</title>\n<style>s</style>a <b>c</b><div>d</div>") == ["a c", "d"]
    assert texts("<head><title>t</title><img src=x>a") == texts("<head><title>t</title><my-part/>a") == ["a"]
    assert texts("<head><title>t</title></head><body><p>a") == texts("<head><title>t<body><p>a") == ["a"]


def test_article_of_labelled_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    model = html.fitted_blocks(pages, sample=20)
    page = (
        "<html><body><div class='menu'><a href=x>Home</a></div><div class=content><h1>Title here</h1><p>First paragraph of a story, with commas.</p>"
        "<p>Second <b>one</b>&nbsp;here, fine.</div><div id=comments><p>I liked it a lot, thanks.</p></div><form><p>Write to us now.</p></form><footer>&copy; 2020</footer>"
    )
    odd = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<nav><a>b</a></nav>"), (4, "u", page)]
    frame = spark.createDataFrame([(*r, 1) for r in odd], "page_id long, url string, html string, text int")
    got = sorted((r.page_id, r.text, r.n_chars) for r in html.extracted(frame, model).collect())
    want = "Title here First paragraph of a story, with commas. Second one here, fine."
    assert got == [(1, want, len(want)), (2, "", 0), (3, "", 0), (4, "", 0), (4, want, len(want))]
    assert html.extracted(frame, html.fitted_blocks(frame.limit(0))).agg({"n_chars": "sum"}).first()[0] == 0


def test_training_pages_are_drawn_from_those_that_name_an_article(spark):
    text = "".join(f"<p>Sentence {k} of a long story, with commas, told at length to the very end of it.</p>" for k in range(3))
    named = [(k, "u", f"<body><nav><a href=x>Home</a></nav><article><h1>Story {k}</h1>{text}</article><footer>&copy; {k}</footer></body>") for k in range(8)]
    plain = [(100 + k, "u", f"<body><div>{k}</div></body>") for k in range(300)] + [(None, "u", "<body><p>same</p></body>")] * 300
    copies = [(None, "u", named[0][2])] * 300
    frame = spark.createDataFrame(plain + copies + named, "page_id long, url string, html string")
    model = html.fitted_blocks(frame, sample=8)
    got = html.extracted(frame.filter("page_id < 8"), model).collect()
    assert len(got) == 8 and all("Sentence 2 of a long story" in r.text and "Home" not in r.text for r in got)
    assert np.allclose(html.fitted_blocks(frame.filter("page_id < 8"), sample=8).weights, model.weights)


# 8 sharding


@pytest.mark.parametrize("rows", [1, 2, 3, 10, 97, 1000])
def test_permutation(spark, rows):
    frame = spark.range(rows).withColumnRenamed("id", "n")
    got = [r.n for r in sharding.permuted(frame, "n", rows, 5).collect()]
    assert sorted(got) == list(range(rows)) and (rows < 10 or got != list(range(rows)))


def test_shards(spark):
    texts = ["é", None, "", "abc", "abc"] * 9
    docs = spark.createDataFrame([(k % 7 if k % 5 else None, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, size int")
    rows = sharding.shuffled_shards(docs.repartition(5)).collect()
    again = sharding.shuffled_shards(docs.repartition(2)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    assert sorted(r["size"] for r in rows) == sorted(len((t or "").encode()) + 1 for t in texts)
    assert sorted(r.text_crc32 for r in rows) == sorted(zlib.crc32((t or "").encode()) for t in texts)
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
    assert all(v == list(range(len(v))) for v in slots.values()) and {len(v) for v in slots.values()} == {5, 6}
    assert sharding.shuffled_shards(docs.limit(0)).count() == 0


# 9 language


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fitted_languages(docs)
    rows = language.identified(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 100 and sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 ²!"), (None, "the and of")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in language.identified(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0, True) and got[None][0] == "en"
    nothing = language.fitted_languages(docs.limit(0))
    assert {r.lang_pred for r in language.identified(odd, nothing).collect()} == {"und"}


def test_every_language_is_learnt(spark):
    rng = random.Random(2)
    words = {f"l{k:02}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for k in range(70)}
    rows = [(100 * n + k, " ".join(rng.choices(own, k=30)), name) for n, (name, own) in enumerate(words.items()) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2)
    model = language.fitted_languages(docs, per_language=5)
    assert model.names == sorted(words) and np.bincount(model.of).max() <= 4
    got = {r.doc_id: r.lang_pred for r in language.identified(docs, model).collect()}
    assert all(got[number] == name for number, _, name in rows)


def test_languages_whose_rows_share_an_id_are_learnt_from_many_texts(spark):
    rng = random.Random(4)
    words = {f"l{k}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for k in range(4)}
    rows = [(None if k == 0 else k, " ".join(rng.choices(own, k=12)), name) for k, (name, own) in enumerate(words.items()) for _ in range(60)]
    rows += [(None, "the same text again", "l0")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learnt = [r.lang for r in language.sample_counts(docs, 20).collect()]
    assert {name: learnt.count(name) for name in words} == dict.fromkeys(words, 20)


def test_grams_do_not_depend_on_chunks(monkeypatch):
    text, blanks = "Größe und Maß; the end. " * 40, language.letters_only()
    whole = language.gram_counts(text, blanks)
    monkeypatch.setattr(language, "CHUNK", 7)
    assert (language.gram_counts(text, blanks) == whole).all()


# 10 personal data


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    only = lambda m: re.sub("[^0-9]", "", m.group())
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(only(m)) <= 19 and luhn(only(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(only(m)) <= 15),
    ]
    return [f"{kind}:{m.start()}:{m.end()}" for kind, pattern, fits in rules for m in re.finditer(pattern, text) if fits(m)]


def test_personal_data(spark):
    rng = random.Random(5)
    texts = [None, "", "é🙂 a@b.c_d@e.f.g 1.2.3.4.5 12.34.56.78.90 999.1.1.1 0255.1.1.1", "1 1.1.1.1 " * 600, "a" * 50_000, "1" * 3_000]
    texts += ["".join(rng.choice("0123456789 .-+()@ab1é") for _ in range(rng.randint(1, 60))) for _ in range(600)]
    card, phone = "4524132264652876", "+1 (269) 555-3296"
    joined = f"{phone} {card}"
    texts += [joined] + [f"call {phone} now" for _ in range(40)] + [f"pay {card}." for _ in range(40)]
    frame = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.personal_data(frame).collect()}
    for k, text in enumerate(texts):
        want, row = base_spans(text or ""), got[k]
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(w.startswith(kind) for w in want) for kind in pii.KINDS]
        assert set(want) <= set(row.spans.split(","))
    assert got[texts.index(joined)].spans == f"card:{len(phone) + 1}:{len(joined)},phone:0:{len(phone)}"
    assert pii.personal_data(frame.limit(0)).count() == 0


@pytest.mark.parametrize("table", ["with", "without"])
def test_what_stands_before_a_local_phone_decides(spark, table):
    rng = random.Random(8)
    some = [f"so +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} and" for _ in range(200)] if table == "with" else []
    phones = ["269-555-3296", "030 1234 5678", "743.555.3824"]
    texts = [f"{cue}{p} today" for p in phones for cue in ("my tel ", "Please phone: ", "fax ", "call ")]
    others = [f"{word}{p} today" for p in phones for word in ("the order ", "serial ", "a total of ", "")]
    kept = ["see (269) 555-3296 now", "+1 (269) 555-3296 4524132264652876", "4465758382889437 4465758382889437", "a.b (at) c.org"]
    frame = spark.createDataFrame(list(enumerate(some + texts + others + kept)), "doc_id long, text string")
    model = pii.fitted(pii.with_candidates(frame).drop("text"))
    got = {r.doc_id: r.text for r in pii.redacted(frame, model).collect()}
    start = len(some)
    assert all("[PHONE]" in got[start + k] for k in range(len(texts))), [got[start + k] for k in range(len(texts))]
    assert [got[start + len(texts) + k] for k in range(len(others))] == others
    assert [got[start + len(texts) + len(others) + k] for k in range(len(kept))] == [
        "see [PHONE] now", "[PHONE] [CARD]", "[CARD] [CARD]", "[EMAIL]",
    ]


def test_redaction(spark):
    texts = [None, "", "mail a.b@c.org, card 4524132264652876", "nothing 12 here"]
    frame = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)], "doc_id long, text string, _text long")
    clean = pii.redacted(frame, pii.Model(boosting.Boosted(-1.0), dict.fromkeys(pii.KINDS, 0.0))).orderBy("doc_id").collect()
    assert [r.text for r in clean] == [None, "", "mail [EMAIL], card [CARD]", "nothing 12 here"] and clean[3]["_text"] == 3


def test_trees_as_expressions(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    x = rng.random((300, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = boosting.fit(x, y, depth=3)
    assert ((model.score(x) > 0) == (y > 0)).mean() > 0.95
    frame = spark.createDataFrame([(row.tolist(),) for row in x], "x array<double>")
    got = [r[0] for r in frame.select(model.expression(lambda k: F.col("x")[k])).collect()]
    assert np.allclose(got, model.score(x))
