"""Tokens, vectors, shards, languages, pages, mixes and conversations against plain versions."""

from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import bpe, chat, forest, html, language, mixing, queries, shards

ODD = "doc_id long, text string, ids string, shard int, target string, score string, __x int"


@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_path()


def odd_texts(corpus):
    rng = random.Random(2)
    long = ["".join(rng.choice("abc'reé中 ") for _ in range(3000)), "".join(rng.choice("theing") for _ in range(3000)), "a" * 2500]
    return [None, "", " \n\t", "İstanbul, 're','s.", "क़ क़. Σας ΟΔΟΣ.", "<|endoftext|>. x<|endoftext|>,", *long, *(t for _, t in corpus[:40])]


def test_tokens_equal_the_library(spark, corpus, path, monkeypatch):
    monkeypatch.setattr(bpe, "LEAF", 200)
    texts = odd_texts(corpus) * 2
    rows = [(i, t, "old", 1, "t", "s", 5) for i, t in enumerate(texts)]
    df = bpe.encode(spark.createDataFrame(rows, ODD), path, decoded="decoded")
    again = bpe.decode(df, path, out="second")
    tokenizer = bpe.read_tokenizer(path)
    got = {r.doc_id: r for r in again.collect()}
    assert len(got) == len(rows) and all(r["__x"] == 5 and r.shard == 1 for r in got.values())
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids
        assert got[i].decoded == got[i].second == tokenizer.decode(ids, skip_special_tokens=False)


def test_joined_halves_equal_one_call(path):
    rng, tokenizer = random.Random(1), bpe.read_tokenizer(path)
    alphabets = ["abcdefghij", "ab", "a", "the and ing 're'll", "<|endoftext|>a ", "éèáë Ω'S", "1234 $%&'", "中文字漢 ", "İßσΣ a"]
    for k in range(400):
        letters = rng.choice(alphabets)
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 1200)))
        leaf = rng.randint(1, 300)
        cuts = [*range(0, len(text), leaf), len(text)]
        parts = [bpe.encode_span(tokenizer, text, a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        assert bpe.join_all(tokenizer, text, parts, cuts).ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, k


def vectors(n, size=16, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, size))
    return (centres[rng.integers(0, 8, n)] + spread * rng.normal(size=(n, size))).astype(np.float32)


def brute_neighbours(rows, k):
    x = np.array([v for _, v in rows], np.float64)
    ids = np.array([i for i, _ in rows])
    return {
        int(i): [int(ids[j]) for j in sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-round(s[j], 9), ids[j]))[:k]]
        for i, s in zip(ids, x @ x.T, strict=True)
        if i % 5 == 0
    }


def test_neighbours_on_clusters(spark):
    v = vectors(1500, spread=0.3)
    v[100:160] = v[100]
    v[7] *= 3
    rows = list(enumerate(v.tolist()))
    df = spark.createDataFrame([*rows, *rows[:30], (None, [1.0] * 16), (9001, None), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [1.0])], "vec_id long, embedding array<float>")
    got = forest.neighbours(df, lambda c: F.col(c) % 5 == 0, k=10).collect()
    want = brute_neighbours(rows, 10)
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == pytest.approx(float(np.dot(v[r.query_id].astype(float), v[r.vec_id].astype(float))), abs=1e-12)
    assert set(by) == set(want) and all(len(x) == 10 for x in by.values())
    assert np.mean([len(set(by[q]) & set(want[q])) / 10 for q in want]) >= 0.9


def test_queries_of_a_small_cluster_ascend_to_k_rows(spark):
    """A cluster of five far from all others: its members' stretches are small in every tree and hold the same few vectors."""
    rng = np.random.default_rng(21)
    centers = np.linalg.qr(rng.normal(size=(32, 32)))[0][:31]
    sizes = [60] * 30 + [5]
    v = np.concatenate([c + 0.002 * rng.normal(size=(n, 32)) for c, n in zip(centers, sizes, strict=True)]).astype(np.float32)
    rows = list(enumerate(v.tolist()))
    got = forest.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda c: F.col(c) % 100 == 0).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert len(rows) == 1805 and set(found) == {q for q, _ in rows if q % 100 == 0}
    assert all(len(x) == 20 for x in found.values())
    assert {1801, 1802, 1803, 1804} <= found[1800]


def test_neighbours_of_few_and_none(spark):
    kind = "vec_id long, embedding array<float>"
    assert forest.neighbours(spark.createDataFrame([], kind), lambda c: F.col(c) % 5 == 0).count() == 0
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 8)], kind)
    got = forest.neighbours(few, lambda c: F.col(c) == 5, k=20).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [7, 6, 4, 3, 2, 1]


def test_table_of_shards_is_even_and_stable():
    names = [f"s{i}" for i in range(20)]
    table = shards.lookup_table(names, 10007)
    sizes = np.bincount(table)
    assert sizes.max() - sizes.min() <= 1
    less = shards.lookup_table(names[:-1], 10007)
    kept = table != 19
    assert np.mean(table[kept] != less[kept]) < 0.1
    claimed, orders = {}, [[(shards._number(n, "offset") + j * (shards._number(n, "skip") % 10006 + 1)) % 10007 for j in range(10007)] for n in names[:3]]
    turn = 0
    while len(claimed) < 10007:
        slot = next(s for s in orders[turn % 3] if s not in claimed) if len(claimed) < 60 else None
        if slot is None:
            break
        claimed[slot] = turn % 3
        turn += 1
    three = shards.lookup_table(names[:3], 10007)
    assert all(three[s] == k for s, k in claimed.items())
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            shards.lookup_table(bad)
    with pytest.raises(ValueError):
        shards.lookup_table(["a"], 100)


def test_placing_rows(spark, tmp_path):
    import xxhash

    names = [f"s{i}" for i in range(5)]
    rows = [(i, None, "x", 3, None, None, 1) for i in range(200)] + [(None, str(i), None, 3, None, None, i) for i in range(100)]
    placed = shards.place(spark.createDataFrame(rows, ODD), ["doc_id"], names, 101)
    got, table = placed.collect(), shards.lookup_table(names, 101)
    assert len(got) == 300 and {r["__x"] for r in got if r.doc_id is not None} == {1}
    for r in got:
        if r.doc_id is not None:
            h = xxhash.xxh64_intdigest(r.doc_id.to_bytes(8, "little"), seed=42)
            assert r.slot == (h - (1 << 64) if h >> 63 else h) % 101
        assert r.shard == names[table[r.slot]]
    assert len({r.slot for r in got if r.doc_id is None}) > 30
    shards.write_shards(placed.drop("ids", "target", "score"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 300


def test_language_accuracy_and_contract(spark, folder):
    got = queries.QUERIES["op5_language_kernel"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").filter("held_out AND lang_pred != 'und' AND lang IS NOT NULL").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.9
    assert all(0 <= r.score <= 1 for r in got.collect())


def test_language_of_odd_texts(spark, documents):
    train = [(i, t) for i, t in enumerate(["alpha beta gamma"] * 5 + ["zwei drei vier"] * 5)]
    df = documents(train).selectExpr("doc_id", "text", "if(doc_id < 5, 'aa', 'bb') AS lang")
    model = language.fit(df)
    odd = spark.createDataFrame([(i, t, "old") for i, t in enumerate([None, "", "12 -- !", "beta", "drei vier" * 50_000, "中文"])], "doc_id long, text string, score string")
    got = [(r.lang_pred, r.score) for r in language.predict(odd, model).orderBy("doc_id").collect()]
    assert [x for x, _ in got[:5]] == ["und", "und", "und", "aa", "bb"] and got[5][0] in ("aa", "bb")
    assert language.fit(df.limit(0)) is None
    assert language.predict(odd, None).filter("lang_pred != 'und'").count() == 0


PAGES = [
    ("<body><div class=menu><a>x</a></div><p>Hello <b>big\n world</b>&nbsp;&amp; co<br>line<p>two<script>if(a<b)'</p>'</script><footer>f", ["Hello big world & co line", "two"]),
    ("<article><header><h1>T</h1></header><p>x < y and <3<section class='comments'><p>no</section><p>z</article><p>out", ["T", "x < y and <3", "z"]),
    ("<main><p>a</p><aside>s</aside><form>f<input>g</form><div class='ad'>ad</div><!-- > <p>c</p> -->b</main>", ["a", "b"]),
    ("<article><p><b>one<br><p>two</article></body", ["one", "two"]),
    ("<p hidden>h<p style='display: none'>n<p>&copy;&#65;&am", ["©A&am"]),
    ("", []), (None, []), ("<", ["<"]), ("<p", []), ("no tags\n at  all", ["no tags at all"]),
]


def test_pages(spark):
    for page, want in PAGES:
        assert html.article_blocks(page)[0] == want, page
    df = spark.createDataFrame([(i, f"http://h{i}/", p, "t") for i, (p, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html.extract(df).collect()}
    for i, (_, want) in enumerate(PAGES):
        assert got[i].text == "\n\n".join(want) and got[i].n_chars == len(got[i].text)
    assert html.extract(df.limit(0)).count() == 0


def test_shared_substrings_go_where_no_article_is_named(spark, partitions):
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(1000)}" for _ in range(n))
    notice, pair = text(12), text(12)
    rows = []
    for i in range(6):
        own = [text(15), text(9)]
        body = f"<p>{own[0]}</p><p>{notice} {own[1]}</p>" + (f"<p>{pair}</p>" if i < 2 else "")
        rows.append((i, f"http://a.org/{i}", f"<body>{body}</body>", "\n\n".join([*own, *([pair] if i < 2 else [])])))
    rows.append((9, "http://b.org/1", f"<p>{notice}</p>", notice))
    rows.append((10, "http://a.org/10", f"<article><p>{notice}</p></article>", notice))
    df = spark.createDataFrame([r[:3] for r in rows] + [rows[0][:3]] * 3, "page_id long, url string, html string")
    for got in partitions(lambda: html.extract(df).collect(), (1, 5)):
        assert len(got) == len(df.collect())
        assert {r.page_id: r.text for r in got} == {r[0]: r[3] for r in rows}


def test_blocks_in_doubt_are_decided_by_the_host(spark, partitions):
    """Inside an article, a header or result block that a host's pages share goes whole, also a short one; the article's own stay whole."""
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(1000)}" for _ in range(n))
    notice, site, result = text(30), text(3), text(12)
    rows = []
    for i in range(6):
        own = [text(4), f"{notice} {text(3)}", text(40), f"{text(2)} {result}", notice]
        marks = f"<div class=header><h1>{own[0]}</h1></div><div class=header>{site}</div><div class='search-results'>{own[1]}</div>"
        page = f"<article>{marks}<p>{own[2]}</p><div id=search-result>{notice}</div><div class=search-form>{text(9)}</div><div class=search-results>{own[3]}</div><p>{own[4]}</p></article>"
        rows.append((i, f"http://a.org/{i}", page, own))
    for i in range(6, 8):  # two pages of a host, and one whose copies count once
        rows.append((i, f"http://b.org/{i}", f"<article><div class=header>{site}</div><p>{i} {notice}</p></article>", [site, f"{i} {notice}"]))
    own = text(300)
    rows += [(i, f"http://c.org/{i}", f"<article><div class=header>{site}</div><p>{own}</p></article>", [site, own]) for i in range(8, 12)]
    rows.append((12, "http://a.org/12", f"<p>{notice}</p>", [notice]))
    rows.append((13, "http://a.org/13", f"<div class=header>{site}</div><main><div class=header>{site}</div>x</main>", ["x"]))
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    for got in partitions(lambda: html.extract(df).collect(), (1, 5)):
        assert {r.page_id: r.text for r in got} == {r[0]: "\n\n".join(r[3]) for r in rows}


def brute_mix_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return sorted(con.execute(mixing.SQL).fetchall(), key=str)


def test_mix_of_odd_rows(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "c", "é", None])) for i in range(800)]
    rows += [(None, "x y", "a"), (None, None, None), (1, "again x", "a"), (1, "again x", "a"), (900, "z " * 3, "tiny"), (901, "", "empty")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, target int")
    mixed = mixing.mix(df)
    assert sorted((tuple(r) for r in mixing.digest(mixed).collect()), key=str) == brute_mix_sql(rows)
    sums = mixed.groupBy("source").agg({"taken": "sum", "target": "max", "source_size": "max"}).collect()
    for r in sums:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 60 and r["sum(taken)"] <= 3 * r["max(source_size)"]
    shard_words = [0] * 16
    for r in mixed.collect():
        assert r.copies <= 3 and len(r.shards) == r.copies
        for s in r.shards:
            shard_words[s] += r.size
    assert mixing.mix(df.limit(0)).count() == 0


def test_mix_is_written_whole(spark, tmp_path):
    df = spark.createDataFrame([(i, "w " * 20, "a" if i % 3 else "b") for i in range(300)], "doc_id long, text string, source string")
    mixed = mixing.mix(df)
    mixing.write_mix(mixed, str(tmp_path / "mix"))
    assert spark.read.parquet(str(tmp_path / "mix")).count() == mixed.agg({"copies": "sum"}).collect()[0][0]


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "<|end|>\n<|turn|>user\n"), (1, 2, "assistant", None), (2, 0, None, "\\ <\\| [\\\\INST]"),
    (2, None, "as\nsistant\\", ""), (None, 0, "assistant", "é中"), (3, 5, "assistant", "tie"), (3, 5, "assistant", "tie"), (3, 5, "user", "<<SYS>> <s></s>[/INST]<"),
]


def brute_chat(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[4]))
        learned = "".join(r[3] or "" for r in own if r[2] == "assistant")
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), sum(len(r[4]) for r in own))
    return out


def test_conversations(spark, partitions):
    kind = "conv_id long, turn long, role string, text string, segment string"
    rows = TURNS + [(50, i, ("user", "assistant")[i % 2], f"t{i} </s>") for i in range(3000)] + queries.TRICKY
    df = spark.createDataFrame([(*r, "old") for r in rows], kind)
    segments = chat.format_turns(df)
    text = {}
    for r in segments.collect():
        role, said = chat.read_segment(r.segment)
        text[(r.conv, r.turn, role, said)] = r.segment
        assert "[INST]" not in r.segment and "</s>" not in r.segment and r.segment.count("<|") == 2
    want = brute_chat([(*r, text[(r[0], r[1], r[2] or "", r[3] or "")]) for r in rows])
    for got in partitions(lambda: chat.read_back(segments).collect(), (1, 6)):
        assert {r.conv_id: tuple(r)[1:] for r in got} == want
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_mirrored_pages_and_nested_articles_keep_their_text(spark, partitions):
    assert html.article_blocks("<main><h1>head</h1><p>long text</p><article>teaser</article></main><p>out")[0] == ["head", "long text", "teaser"]
    rng = random.Random(7)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    article, notice, rows = text(300), " ".join(text(12)), []
    for i in range(12):
        words = list(article)
        if i >= 4:  # four equal copies, eight with a word of their own
            words[rng.randrange(300)] = f"x{i}"
        rows.append((i, f"http://a.org/{i}", f"<p>{notice}</p><p>{' '.join(words)}</p>", " ".join(words)))
    for i in range(12, 16):
        own = " ".join(text(60))
        rows.append((i, f"http://a.org/{i}", f"<p>{notice}</p><p>{own}</p>", own))
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    for got in partitions(lambda: html.extract(df).collect(), (1, 5)):
        assert {r.page_id: r.text for r in got} == {r[0]: r[3] for r in rows}


def test_languages_of_large_alphabets(spark):
    """Scripts of thousands of letters, and two languages that share one of them, are told apart; n-grams of unlike letters differ."""
    rng = np.random.default_rng(8)
    stocks = {
        "zh": [chr(0x4E00 + int(i)) for i in rng.choice(6000, 700, replace=False)], "ja": [chr(0x3041 + i) for i in range(80)],
        "ko": [chr(0xAC00 + int(i)) for i in rng.choice(9000, 700, replace=False)], "el": [chr(0x3B1 + i) for i in range(24)],
        "yue": [chr(0x4E00 + int(i)) for i in rng.choice(6000, 700, replace=False)],
    }
    rows = [(i, "".join(rng.choice(stocks[lang], 200)), lang) for i, lang in enumerate(list(stocks) * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df.filter("doc_id < 100"))
    got = language.predict(df.filter("doc_id >= 100"), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    numbers = language.gram_set("ab ba")
    assert len(numbers) == len(set(numbers.tolist())) == 13
