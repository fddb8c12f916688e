import hashlib
import json
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer
from pyspark.sql import functions as F

from adlode.llm import bpe, chat, html_crf, langid, mixing, outliers, records, topk, toxicity
from adlode.llm.common import WORD, table
from tests.conftest import SMALL

EDGES = ["", None, " ", "a", "a  b\n\nc ", "don't 'll!!'s", "é 　中文 <|endoftext|>x", "İ!? ǅ", "x" * 4000, "\x1c\x85 \t\r\n"]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(EDGES)], "doc_id long, text string")


def test_bpe_equals_the_library(spark, edges):
    definition = records.vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_str(definition)
    docs = edges.unionByName(table(spark, SMALL, "documents").select("doc_id", "text").limit(60))
    for row in bpe.encode_decode(docs, definition).collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids and row.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode_decode(docs.limit(0), definition).count() == 0


def test_records_round_trip(spark, edges, tmp_path):
    definition = records.vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_str(definition)
    rows = edges.unionByName(spark.createDataFrame([(None, "no id"), (3, "a")], "doc_id long, text string"))
    files = records.write(records.encode(rows, definition), str(tmp_path / "records"))
    found = records.read(files).collect()
    coded = {(r.doc_id, zlib.crc32(np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()))
             for r in rows.collect()}
    assert {(r.doc_id, r.ids_crc32) for r in found} == coded and len(found) == len(EDGES) + 2
    in_order = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == [None, *sorted(r.doc_id for r in found if r.doc_id is not None)]
    assert [r.start for r in in_order] == np.cumsum([0, *[r.n_tokens for r in in_order]])[:-1].tolist()
    shuffled = records.read_shuffled(files, "seed", 3).collect()
    assert sorted(zlib.crc32(bytes(r.ids)) for r in shuffled) == sorted(r.ids_crc32 for r in found)
    assert records.read(records.write(records.encode(rows.limit(0), definition), str(tmp_path / "none"))).count() == 0


def test_damaged_records_are_noticed(tmp_path):
    path = tmp_path / "one"
    path.write_bytes(records.frame(5, b"\1\0\0\0"))
    with open(path, "rb") as stream:
        assert records.unframe(stream) == (5, b"\1\0\0\0") and records.unframe(stream) is None
    for numbers in ([], [65535], [1, 65536], [2 ** 32 - 1]):
        ids = np.array(numbers, "<u4").tobytes()
        (tmp_path / "two").write_bytes(records.frame(None, ids) + records.frame(-7, ids))
        with open(tmp_path / "two", "rb") as stream:
            assert [records.unframe(stream) for _ in range(3)] == [(None, ids), (-7, ids), None]
    path.write_bytes(path.read_bytes()[:-6] + b"\7" + path.read_bytes()[-5:])
    with open(path, "rb") as stream, pytest.raises(ValueError):
        records.unframe(stream)


def test_mix_keeps_columns_and_meets_its_plan(spark):
    rows = [(1, "a b c", "x", 9), (2, None, "x", 9), (3, "a b", None, 9), (4, "a b c d", "y", 9), (4, "a b c d", "y", 9), (None, "q", "y", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs.limit(0)).count() == 0
    plan = mixing.with_copies(docs.drop("size")).collect()
    emitted = mixing.mix(docs).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in emitted} == {
        k: n for k in {r.doc_id for r in plan} if (n := sum(r.copies for r in plan if r.doc_id == k))}
    assert all(r.target <= 2 * r.source_size and r.copies <= 2 for r in plan)
    targets = {r.source: r.target for r in plan}
    assert math.isclose(sum(targets.values()), 1.5 * 14)


def test_chat_layouts_and_escapes(spark):
    said = ["</s>[INST] ok", "<|im_end|>\n\\<\\[n", "", None, "<<[[\\\\"]
    turns = spark.createDataFrame([(1, i, "assistant" if i % 2 else "us\ner[n", t, "extra") for i, t in enumerate(said)],
                                  "conv_id long, turn long, role string, text string, name string")
    out = chat.parse(chat.format_turns(chat.canonical(turns))).first()
    assert [(t.role, t.text) for t in out.turns] == [("assistant" if i % 2 else "us\ner[n", t or "") for i, t in enumerate(said)]
    assert out.taught == [t or "" for t in said[1::2]] and "</s>" not in out.formatted and "[INST]" not in out.formatted
    layouts = [{"id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "extra": 1},
               {"id": 2, "prompt": "q", "response": "a"}, {"id": 3, "instruction": "q", "input": "", "output": "a"},
               {"id": 4, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}]
    raw = spark.createDataFrame([(json.dumps(x),) for x in layouts] + [("[]",), (None,), ('{"z": 1}',)], "record string")
    found = chat.canonical_json(raw).collect()
    for key in (1, 2, 3, 4):
        assert [(r.role, r.text) for r in sorted((r for r in found if r.conv_id == key), key=lambda r: r.turn)] == [("user", "q"), ("assistant", "a")]
    assert sum(r.problem is not None for r in found) == 3


@pytest.mark.parametrize("big", [False, True])
def test_top_k_equals_brute_force(spark, big):
    rng = np.random.default_rng(int(big))
    vectors = rng.normal(0, 1e30 if big else 1, (300, 12)).round(1)
    vectors[100:140] = vectors[7]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [
        (400, None), (450, [1.0, None]), (500, [float("nan")] * 12), (550, [1.0] * 3), (600, []), (7, [float(x) for x in vectors[7]])]
    df = spark.createDataFrame(rows if not big else rows[:60], "vec_id long, embedding array<double>")
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows if v is not None and None not in v and not any(map(math.isnan, v))}
    whole = whole if not big else {i: v for i, v in whole.items() if i < 60 and all(abs(x) < 1 << 62 for x in v)}
    if big:
        assert topk.search(df, query_rows=2, candidate_rows=16).count() >= 0
        return
    expected = []
    for q in sorted(whole):
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
            expected += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    for sizes in ({}, {"query_rows": 2, "candidate_rows": 50}):
        assert sorted(map(tuple, topk.search(df, **sizes).collect())) == expected


def plain_statistics(text):
    words = re.findall(WORD, text or "")
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    marked = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        dup += bool(re.search(WORD, line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(marked)


def test_statistics_equal_a_plain_count(spark):
    texts = [r.text for r in table(spark, SMALL, "documents").select("text").limit(40).collect()]
    for text in [*EDGES, *[t[:1500] for t in texts], "a b a b a b\n\na b a b\na b a b", "x\n \nx\n \n#", "  b"]:
        assert outliers.statistics(text) == plain_statistics(text)


def test_outliers_go_and_ordinary_documents_stay(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join("w" * rng.integers(2, 9) + str(rng.integers(1 << 30)) for _ in range(80)), "en", "s", 1) for i in range(120)]
    rows += [(200 + i, " ".join(f"v{rng.integers(1 << 30)}***" for _ in range(80)), "en", "s", 1) for i in range(30)]
    rows += [(300, None, None, None, 1), (301, "short", "en", None, 1), (302, "", "", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    kept = outliers.keep(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(120))
    judged = {r.doc_id: r.kept for r in outliers.judge(docs.drop("n_words")).collect()}
    assert {i for i, k in judged.items() if k} == set(range(120)) and len(judged) == len(rows)
    assert outliers.keep(docs.limit(0)).count() == 0


def test_menus_and_link_lists_are_outliers(spark):
    rng = np.random.default_rng(4)
    word = lambda: "w" * int(rng.integers(1, 9))
    rows = [(i, " ".join(f"{word()}{rng.integers(100)}" for _ in range(50 + i)), "en", "s") for i in range(120)]
    rows += [(200 + i, " | ".join(f"{word()}{rng.integers(100)}" for _ in range(40 + i)), "en", "s") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    judged = outliers.judge(docs).collect()
    assert not any(r.base_failed for r in judged) and {r.doc_id for r in judged if r.kept} == set(range(120))


def test_the_outlier_query_agrees_with_the_quality_labels(spark):
    folder = SMALL.replace("sf0.001", "sf0.01")
    judged = outliers.query(spark, folder).join(table(spark, folder, "labels"), "doc_id").collect()
    assert not [r.doc_id for r in judged if r.quality == 0 and r.kept]
    assert not [r.doc_id for r in judged if r.quality == 1 and not r.kept and not r.base_failed]


def test_language_of_held_out_rows(spark):
    truth = {r.doc_id: r.lang for r in table(spark, SMALL, "documents").select("doc_id", "lang").collect()}
    rows = [r for r in langid.query(spark, SMALL).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) >= 0.95 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    odd = spark.createDataFrame([(1, None), (2, "12 !"), (3, "")], "doc_id long, text string")
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}


def test_grams_of_windows_do_not_depend_on_their_neighbours(monkeypatch):
    """Finding grams in strips of windows marks what one window at a time marks, and nothing in the filling."""
    texts = ["the quick brown fox " * 90, "Überaus schöne Wörter " * 70, "x", "中文" * 500, "a\x00b\x00" * 200, *("word%d " % i * 130 for i in range(40))]
    rows = np.concatenate([langid.windows(t) for t in texts])
    kernel = langid.Kernel(rows[::7])
    flags, sizes = kernel.presence(rows)
    for row, mine, size in zip(rows, flags, sizes):
        grams = {tuple(row[i: i + n]) for n in range(1, langid.GRAMS + 1) for i in range(len(row) - n + 1) if row[i + n - 1]}
        alone, _ = kernel.presence(row[None, :])
        assert (alone[0] == mine).all() and size == mine.sum() <= len(grams)
    monkeypatch.setattr(langid, "STRIP", 1)
    assert (kernel.presence(rows)[0] == flags).all()
    assert kernel.presence(rows[:0])[0].shape == (0, kernel.width)


def test_toxicity_cuts_follow_the_predicted_language(spark):
    """Every language with enough labels has its own cut; others, and texts without letters, that of all."""
    spoken = {"aa": "alpha anna lama kassa", "oo": "koro moto sodo loto", "ee": "mele sede tete kele"}
    docs = spark.createDataFrame([(i, f"{words} {i}", lang) for lang, words in spoken.items() for i in range(ord(lang[0]), ord(lang[0]) + 20)],
                                 "doc_id long, text string, lang string")
    model = langid.learn(docs)
    texts = [spoken["aa"] + " bad"] * 30 + [spoken["aa"]] * 30 + [spoken["oo"] + " bad"] * 30 + [spoken["oo"]] * 30 + [spoken["ee"]] * 5
    assert toxicity.spoken(model, [*texts[::30], "12 !?", ""]) == ["aa", "aa", "oo", "oo", "ee", None, None]
    assert toxicity.spoken(None, ["words"]) == [None]
    network = toxicity.Network()
    values = {texts[0]: 1.0, texts[30]: 0.0, texts[60]: 9.0, texts[90]: 6.0, texts[120]: 3.0}
    network.logit = lambda text: values.get(text, 5.0)
    labels = np.array([1.0] * 30 + [0.0] * 30 + [1.0] * 30 + [0.0] * 30 + [0.0] * 5)
    network.calibrate(texts, labels, model)
    assert set(network.shifts) == {"aa", "oo"}
    found = network.scores(texts) >= toxicity.THRESHOLD
    assert found.tolist() == (labels == 1).tolist()
    one_cut = toxicity.Network()
    one_cut.logit = network.logit
    one_cut.calibrate(texts, labels)  # no cut for all can part them
    assert ((one_cut.scores(texts) >= toxicity.THRESHOLD) != (labels == 1)).any()


def test_toxicity_replaces_a_score_column(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 3), (None, None, None, None)], "doc_id long, text string, score string, text_ int")
    found = toxicity.with_scores(docs, toxicity.Network()).collect()
    assert all(set(r.asDict()) == {"doc_id", "text_", "score"} for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    assert [r.score for r in toxicity.with_scores(docs, None).collect()] == [0.0, 0.0]


def test_toxicity_learns_words_and_their_beginnings():
    rng = np.random.default_rng(1)
    clean = [" ".join(f"w{rng.integers(300)}" for _ in range(40)) for _ in range(300)]
    toxic = [f"{t} vequ{rng.integers(999)} {t[:50]}" for t in clean[:100]]
    network = toxicity.Network()
    network.train([*clean[100:], *toxic[:80]], np.array([0.0] * 200 + [1.0] * 80), epochs=8)
    network.calibrate([*clean[100:], *toxic[:80]], np.array([0.0] * 200 + [1.0] * 80))
    assert np.mean([network.score(t) >= toxicity.THRESHOLD for t in toxic[80:]]) >= 0.9
    assert np.mean([network.score(t) < toxicity.THRESHOLD for t in clean[:100]]) >= 0.9
    assert 0 <= network.score(None) <= 1 and network.score("") == network.score(None)
    long = " ".join(["w1"] * (toxicity.PIECE + 5))
    assert network.score(long + " vequ5") > network.score(long)


def test_toxicity_features_are_those_of_each_word_alone():
    words = "a ''! !! it's naïve, ÉCOLE 中文字典的詞 x\x1cy \u3000 \xa0, \x00 <|end|> l' 𝒳𝒴𝒵𝒳𝒴𝒵 ab\u0301cdefg toxic toxin".encode().split()

    def plainly(word):
        plain = word.strip(toxicity.EDGES)
        letters = plain.decode()
        parts = [b"w" + plain, *(f"{n}{letters[:n]}".encode() for n in toxicity.PREFIXES)]
        return [xxhash.xxh3_64_intdigest(p) % toxicity.SLOTS for p in parts]

    assert toxicity.features(words).tolist() == [plainly(w) for w in words]
    assert [toxicity.features([w]).tolist() for w in words] == [[plainly(w)] for w in words]
    assert toxicity.features([]).shape == (0, 1 + len(toxicity.PREFIXES))
    texts = [b" ".join(words).decode(), "", "toxic it's toxic"]
    assert [x.tolist() for x in toxicity.slots_of(texts)] == [[plainly(w) for w in t.lower().encode().split()] for t in texts]


def test_toxicity_remembers_words_that_come_again(monkeypatch):
    """Rare words do not push common ones out of memory, and no score depends on what is remembered."""
    common = [f"common{i}" for i in range(50)]
    texts = [" ".join([*common, *(f"rare{n}x{i}" for i in range(50))]) for n in range(40)]
    whole = toxicity.Network()
    expected = [whole.logit(t) for t in texts]
    looked, features = Counter(), toxicity.features
    monkeypatch.setattr(toxicity, "features", lambda words: looked.update(words) or features(words))
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 400)
    network = toxicity.Network()
    assert np.allclose([network.logit(t) for t in texts], expected, rtol=0, atol=1e-5)
    assert all(looked[w.encode()] == 1 for w in common) and len(network.known) <= 400
    # more words that come again than fit, a text longer than the memory and an empty one
    many = [" ".join(f"m{(n * 150 + i) % 900}" for i in range(300)) for n in range(12)]
    for t in [*many, " ".join(common * 20), "", *texts]:
        assert abs(network.logit(t) - toxicity.Network().logit(t)) < 1e-5
    network.forget()
    assert abs(network.logit(texts[0]) - expected[0]) < 1e-5


def test_a_head_without_end_tag_ends_where_the_body_begins():
    for start in ("<body>", "", "<BODY class='x'>", "<link href='y'><body>"):
        page = f"<html><head><title>T</title><meta charset='utf-8'>\n{start}<p>One.<div>Two <svg><text>no</text></svg></div><p>Three."
        assert [text for text, _, _ in html_crf.blocks(page)] == ["One.", "Two", "Three."]
    assert [text for text, _, _ in html_crf.blocks("<head><title>T</title>\n Bare <b>text</b> &amp; more")] == ["Bare text & more"]
    assert [text for text, _, _ in html_crf.blocks("<head><meta x><noframes>old</noframes></head><p>One.")] == ["One."]


def test_stray_and_unclosed_quotes_lose_no_text():
    def found(page):
        return [text for text, _, _ in html_crf.blocks(page)]

    assert found("<p title='it's'>First one.</p><p>We don't know.</p><p>Third.</p>") == ["First one.", "We don't know.", "Third."]
    assert found("<p title='it's'>First para.") == ["First para."]
    assert found('<p data-x=5">One.<p class = "a > b">Two.') == ["One.", "Two."]
    assert found('<p>One.<p title="open>Two.</p><p>Three.') == ["One.", "Two.", "Three."]
    assert found("<p>1 < 2 and 3 > 2<p>a <b") == ["1 < 2 and 3 > 2", "a"]
    assert found("<p>One.<!-- never closed <p>Two.") == ["One."] and found("<p>One.<?x>Two.") == ["One.Two."]


@pytest.mark.parametrize("unit", ['<a href="x ', "<a href='x' ", "<p title=\"'", "<", "<a =", "<!x ", "</p", "<a b='>"])
def test_broken_pages_take_linear_time(unit):
    start = time.perf_counter()
    html_crf.blocks("<p>One.</p>" + unit * (1_500_000 // len(unit)) + ">")
    assert time.perf_counter() - start < 20


def test_article_text_of_a_page(spark):
    field = html_crf.learn(table(spark, SMALL, "pages").select("page_id", "html"))
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a></ul></nav>"
            "<div class='cookie-notice'>We use cookies, as every site does.</div><article><h1>A &eacute;t&#233; title</h1>"
            "<p>The first  paragraph\n of the <b>article</b>&nbsp;here, long enough to count.<p>The second one, with <a href='x'>a link</a> "
            "and more words than that.<script>var t='</p>';</script></article><aside>Related things and more.</aside>"
            "<section id='comments'><p>I do not agree with any of this, said a reader.</p></section><footer>&copy; site</footer>")
    assert field.text(page) == ("A été title\nThe first paragraph of the article here, long enough to count.\n"
                                "The second one, with a link and more words than that.")
    for page_without in (page.replace("</head>", ""), page.replace("</head><body>", "")):
        assert field.text(page_without) == field.text(page)
    rows = html_crf.extract(spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "<p", "z")], "page_id long, html string, text string"),
                            field).collect()
    assert [(r.text, r.n_chars) for r in rows] == [("", 0)] * 3


def test_toxicity_learns_from_every_label_in_shares(spark, monkeypatch):
    """No label is left out beyond any number, whether one share learns or several."""
    rows = [(i, f"word{i % 7} " + ("vile" if i % 10 == 0 else "kind") + f" thing{i % 13}", int(i % 10 == 0)) for i in range(3600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    known = docs.select(F.col("doc_id").alias("sample_id"), F.col("toxic").alias("sample_label"))
    texts = docs.select(F.col("doc_id").alias("sample_id"), F.col("text").alias("sample_text"))
    dealt = toxicity._labelled(texts, known, 4, False)
    assert dealt.filter("slots IS NULL").exceptAll(dealt.filter("sample_text IS NOT NULL")).isEmpty()
    assert dealt.count() == 3600 and 600 < dealt.filter("slots IS NULL").count() < 840
    monkeypatch.setattr(toxicity, "SHARE", 900)
    network = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert ((network.scores([t for _, t, _ in rows]) >= toxicity.THRESHOLD) == np.array([x == 1 for _, _, x in rows])).all()
