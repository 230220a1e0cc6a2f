"""The operators against brute force on small tables with nulls, ties, copies and long texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from fleetgauge.llm import (
    html_template,
    kneser_ney,
    language_id,
    mixing,
    ngram_join,
    ppm,
    quality_rules,
    sentencepiece_codec,
    topk_search,
    url_reputation,
)

public_tokenizers = pytest.importorskip("public_tokenizers")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _body string, score int"
BASE = " ".join(f"word{i}" for i in range(80))
TEXTS = [
    None,
    "",
    " \n\t ",
    "!!! 12",
    "one two",
    "one  TWO",
    BASE,
    BASE.upper(),
    BASE + " tail",
    BASE.replace("word3 ", "other "),
    " ".join(f"word{i}" for i in range(40)),
    "und der die das ist nicht " * 40,
    "the and of to that with " * 40 + "\n" + "the and of\n" * 3,
    " ".join(f"long{i % 7001}" for i in range(30_000)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "de" if t and "und" in t else "en", f"s{i % 3}", 0, "x", 1) for i, t in enumerate(TEXTS)]
    rows += [(6, BASE, None, None, 0, "x", 1), (None, BASE, "en", "s0", 0, "x", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 4 != 0), 0) for i in range(4, len(TEXTS))] + [(None, 1, None), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_components_match_all_pairs(spark, docs):
    sets = {}
    for r in docs.collect():
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in _words(r.text)]
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    root = {k: k for k in sets}
    ids = sorted(k for k in sets if k is not None)
    for _ in ids:
        for a in ids:
            for b in ids:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    root[None] = root[6]
    found = ngram_join.similar_documents(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(set(root.values()))
    assert ngram_join.similar_documents(docs.limit(0)).count() == 0


def _linked_components(texts):
    sets = []
    for t in texts:
        w = _words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))], sets


@pytest.mark.parametrize("seed", range(3))
def test_cores_with_more_or_less_around_them(spark, seed):
    """A passage that all have, with own words of every length: most share it, few or many link."""
    dice = np.random.default_rng(seed)
    core = [" ".join(f"c{k}w{i}" for i in range(60)) for k in range(3)]
    texts = []
    for i in range(240):
        own = lambda n: " ".join(f"o{i}x{j}" for j in range(n))
        size = int(dice.integers(0, 30))
        texts.append(f"{own(size)} {core[i % 3]} {own(size // 3)}" if i % 4 else f"{core[0]} {own(size)} {core[1]}")
    texts += [texts[0]] * 3 + [texts[5] + " tail"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    expected, sets = _linked_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(docs).collect()}
    assert got == {i: (len(sets[i]), expected[i]) for i in range(len(texts))}


def test_one_row_of_each_component_stays(spark):
    schema = "doc_id long, text string, _name string, mark int"
    rows = [(1, BASE), (1, BASE.upper()), (2, BASE + " x"), (1, "quite another text of six words"), (None, BASE)]
    rows += [(None, None), (3, None), (3, " "), (4, ""), (None, "unknown text with five words"), (None, "unknown text with five words")]
    docs = spark.createDataFrame([(i, t, "n", 0) for i, t in rows], schema)
    kept = sorted(str((r.doc_id, r.text)) for r in ngram_join.keep_one_of_each(docs).collect())
    one = [t for t in (BASE, BASE.upper()) if str((1, t)) in kept]
    assert len(one) == 1
    left = [(1, one[0]), (1, rows[3][1]), (None, None), (3, None), (3, " "), (4, ""), (None, rows[9][1])]
    assert kept == sorted(str(r) for r in left)
    assert ngram_join.keep_one_of_each(docs.limit(0)).collect() == []


def test_statistics_match_plain_counts(docs, labels):
    for r in quality_rules.text_statistics(docs.select("doc_id", "text")).collect():
        w = _words(r.text)
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        from collections import Counter

        many = Counter(grams)
        hit = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)}
        lines = [x for x in (r.text or "").split("\n") if _words(x)]
        assert r.n_words == len(w) and r.word_chars == sum(map(len, w))
        assert r.n_repeat_words == len(hit)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", r.text or ""))
    judged = quality_rules.quality_rules(docs, labels)
    assert judged.count() == docs.count()
    assert judged.where("base_failed AND kept").count() == 0
    assert quality_rules.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_learned_rule_finds_junk(spark):
    rows = [(i, "a b c " + " ".join(f"w{i}x{k}" + ("###" if i % 5 == 0 else "") for k in range(80))) for i in range(400)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    found = quality_rules.quality_rules(texts, marks)
    assert found.where((F.col("doc_id") % 5 == 0) == F.col("kept")).count() == 0


def test_languages_and_mixture(docs):
    model = language_id.learn(docs)
    found = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert found[11].lang_pred == "de" and found[12].lang_pred == "en"
    assert found[0].lang_pred == found[3].lang_pred == "und" and found[0].score == 0
    assert all(0 <= r.score <= 1 for r in found.values())
    half = ("und der die das ist nicht " * 20 + "the and of to that with " * 20).encode()
    chosen, parts = language_id.mixture(model, np.frombuffer(half, np.uint8))
    assert len(chosen) == 2 and abs(parts.sum() - 1) < 1e-6
    assert language_id.held_out_identification(docs).count() == docs.count()
    assert language_id.keep_identified(docs).columns == docs.columns
    nothing = language_id.learn(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_search_matches_all_scores(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8).round(2)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 340)] + [(400, None), (450, [1.0, None] * 4), (500, [float("nan")] * 8)]
    rows += [(550, [1e9] * 8), (600, [1.0, 2.0]), (601, [3.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = {i: np.floor(256 * np.array(v)).astype(int).tolist() for i, v in rows if v and None not in v and not np.isnan(v[0])}
    expected = set()
    for q in (i for i in good if i % 50 == 0):
        scores = [(-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
        expected |= {(q, rank, i, min(-s, 2**63 - 1)) for rank, (s, i) in enumerate(sorted(scores)[:5], 1)}
    found = topk_search.top_k(vectors, F.col("vec_id") % 50 == 0).collect()
    assert {tuple(r) for r in found} == expected


def test_pfair_deviation_and_completeness(spark, docs):
    weights = {"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05}
    slots = mixing.shares(weights, 200)
    order, served = mixing.cycle_order(slots), dict.fromkeys(weights, 0)
    for now, s in enumerate(order, 1):
        served[s] += 1
        assert all(abs(served[k] - now * slots[k] / 200) < 1 for k in weights)
    rows = mixing.schedule(docs, block=2, cycle=10).collect()
    assert len(rows) == docs.count()
    assert len({(r.slot, r.place) for r in rows}) == len(rows)
    many = spark.range(5000).selectExpr("id AS doc_id", "'t' AS text", "IF(id % 3 = 0, 'hot', concat('s', id % 20)) AS source")
    slots = mixing.schedule(many, {"hot": 1.0}).collect()
    assert sorted({r.slot for r in slots}) == list(range(len({r.slot for r in slots})))
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.schedule(docs.limit(0)).count() == 0


def test_encoding_equals_the_library_and_comes_back(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coded = sentencepiece_codec.encode(docs.select("doc_id", "text"), PIECES, giant=1000)
    for r in sentencepiece_codec.decode(coded, PIECES).collect():
        assert r.ids == (None if r.text is None else library.encode(r.text))
        assert r.decoded == r.text
    model = sentencepiece_codec.lattice(PIECES)
    word = sentencepiece_codec.prepared("abcdeéß漢🙂nrtsh<|>" * 30)
    assert model.long_word(word, 13) == library.encode(word[1:])


def test_new_words_are_solved_side_by_side(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = sentencepiece_codec.Lattice.load(PIECES)
    letters = [*"aehinrstaehinrst ", "  ", "é", "ß", "漢", "🙂", "\0", "\n", "▁", "\U0010fffd"]
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(letters, n)) for n in rng.integers(0, 300, 500)] + [None, "", " ", "x" * 100, "\0"]
    alone, only_path = [], model.only_path
    monkeypatch.setattr(model, "only_path", lambda w: alone.append(w) or only_path(w))
    packed = sentencepiece_codec.encode_words(model, [sentencepiece_codec.words_within(model, t) for t in texts])
    assert [None if x is None else np.frombuffer(x, np.int32).tolist() for x in packed] == [
        None if t is None else library.encode(t) for t in texts
    ]
    most = sentencepiece_codec.FEW * math.ceil(len(model.words) / sentencepiece_codec.TOGETHER)
    assert len([w for w in alone if len(w) <= sentencepiece_codec.ORDINARY]) <= most < len(model.words) / 20


def test_columns_of_ids_decode_as_rows_do(monkeypatch):
    model = sentencepiece_codec.lattice(PIECES)
    rng = np.random.default_rng(6)
    sound = [model.word(sentencepiece_codec.prepared(t)).tolist() for t in ["a b", "é漢🙂 \U0010fffd", " "]]
    mark = [model.byte_ids[b] for b in "▁".encode()]
    broken = [rng.integers(0, top, n).tolist() for top in (300, len(model.name_of)) for n in rng.integers(0, 30, 50)]
    parted = [model.byte_ids[0xC3], model.unknown, model.byte_ids[0xA9]]
    for rows in ([*sound, None, [], sound[0] + mark + mark], [*broken, None], [parted], [None], []):
        lists = pa.array([[7], *rows], pa.list_(pa.int32())).slice(1)
        wanted = [None if r is None else sentencepiece_codec.decode_ids(model, r) for r in rows]
        assert sentencepiece_codec.decode_lists(model, lists).to_pylist() == wanted
    monkeypatch.setattr(sentencepiece_codec, "decode_ids", None)  # sound rows need no turn of their own
    assert sentencepiece_codec.decode_lists(model, pa.array(sound, pa.list_(pa.int32()))).to_pylist()[0] == "a b"


def test_unigram_matrices_match_one_path():
    pieces = {"▁": -3.0, "▁a": -2.5, "a": -2.0, "b": -2.2, "ab": -3.0, "ba": -3.3, "aba": -5.5, "bb": -3.1}
    model = sentencepiece_codec.Lattice({p: (i, s) for i, (p, s) in enumerate(pieces.items())}, [], merges=False)
    rng = np.random.default_rng(1)
    for _ in range(20):
        text = "▁" + "".join(rng.choice(list("ab"), 60))
        one, many = model.word(text), model.long_word(text, 7)
        score = [sum(pieces[model.names[i]] for i in ids) for ids in (one, many)]
        assert abs(score[0] - score[1]) < 1e-9
        assert "".join(model.names[i] for i in many) == text


def test_rules_and_hosts(spark):
    urls = [None, "no scheme", "http://A.net/x", "https://m.example.net/en/1?q", "http://example.com/de/3", "http://b.org/fr/#x", "http://bad.example.org/en/7", "ftp://"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    outcomes = spark.createDataFrame([("bad.example.org", True)] * 60 + [("good.example.org", False)] * 200, "host string, bad boolean")
    found = {r.page_id: r for r in url_reputation.judge_urls(pages, outcomes).collect()}
    assert [found[i].rule for i in range(8)] == [None, None, "net/", "example.net/en/", "example.com/de/", "org/fr/", None, None]
    assert [found[i].verdict for i in range(2, 7)] == ["block", "allow", "block", "allow", "block"]
    assert (found[0].host, found[3].host, found[3].path, found[5].path) == ("", "m.example.net", "/en/1", "/fr/")
    assert url_reputation.judge_urls(pages, outcomes.limit(0)).count() == 8


def test_main_text(spark):
    page = "<html><head><title>T</title><script>x</script></head><body><nav><a href='/'>Home</a></nav><div class='ad'>Buy</div><article><h1>Head</h1><p><b>One &amp; two.<br>three<p>Four\n five.</article><div id='comments'><p>First!</div><footer>&copy;</footer></body></html>"
    rows = [(i, f"http://h.example.org/{i}", page.replace("Four", f"Four{i}")) for i in range(6)] + [(6, None, None), (7, "http://h.example.org/7", "")]
    found = {r.page_id: r.text for r in html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[2] == "Head\nOne & two. three\nFour2 five."
    assert found[6] == found[7] == ""


def test_scores_match_plain_counts(docs):
    rows = docs.collect()
    tokens = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in _words(t)] + ["\n"]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    seen = Counter(w for r in rows if not held(r.doc_id) for w in tokens(r.text))
    n, v = sum(seen.values()), len(seen)
    expected = sorted(
        (str(r.doc_id), len(tokens(r.text)), sum(seen[w] > 0 for w in tokens(r.text)), round(sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(r.text)), 4))
        for r in rows
    )
    found = ppm.score_documents(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 4)) for r in found) == expected
    assert all(r.train_tokens == n and r.score < 0 and r.held_out == held(r.doc_id) for r in found)
    trie = {}
    for r in rows:
        if not held(r.doc_id):
            data = bytes(5) + (r.text or "").encode()
            for at, symbol in enumerate([*data[5:], 256], 5):
                for k in range(6):
                    trie.setdefault(data[at - k : at], Counter())[symbol] += 1
    whole = sorted((str(r.doc_id), _code_length(trie, (r.text or "").encode())) for r in rows)
    for (doc_id, expected), (other, score) in zip(whole, sorted((str(r.doc_id), r.score) for r in found)):
        assert doc_id == other and score == pytest.approx(expected, rel=1e-6)


def _code_length(trie, text):
    data, out = bytes(5) + text, 0.0
    for at, symbol in enumerate([*data[5:], 256], 5):
        ruled_out = set()
        for k in range(5, -1, -1):
            followers = trie.get(data[at - k : at], {})
            left = {s: n for s, n in followers.items() if s not in ruled_out}
            size = sum(left.values()) + len(left)
            if symbol in left:
                out += math.log10(left[symbol] / size)
                break
            if left:
                out += math.log10(len(left) / size)
            ruled_out |= set(left)
        else:
            out -= math.log10(257 - len(ruled_out))
    return out


def test_a_long_text_is_scored_in_parts(spark, monkeypatch):
    data = np.frombuffer(("größe " * 50 + "the end").encode(), np.uint8)
    whole = np.concatenate([k for k, _ in ppm.grams(data, np.array([0, len(data)]))])
    monkeypatch.setattr(ppm, "PART", 7)
    cut = np.concatenate([k for k, _ in ppm.grams(data, np.array([0, len(data)]))])
    both = next(ppm.grams(np.r_[data, data], np.array([0, len(data), 2 * len(data)])))
    assert (whole == cut).all()
    assert (np.sort(both[0][both[1] == 1]) == np.sort(whole)).all()


def test_prices_of_all_symbols_add_up_to_one():
    rng = np.random.default_rng(7)
    text = rng.choice(np.frombuffer(b"abc \xc3", np.uint8), 3000)
    keys, n = np.unique(next(ppm.grams(text, np.array([0, len(text)])))[0], return_counts=True)
    pairs = ppm.context_of(keys, 2) * ppm.SYMBOLS + (keys & 511)
    found, at = np.unique(pairs, return_inverse=True)
    near = ppm.Near(found, np.bincount(at, n))
    every = np.unique((keys >> 9 << 9)[:, None] + np.arange(ppm.SYMBOLS))
    counts = np.zeros(len(every))
    counts[np.searchsorted(every, keys)] = n
    p = 10.0 ** ppm.prices(every, counts, near)
    assert np.abs(p.reshape(-1, ppm.SYMBOLS).sum(axis=1) - 1).max() < 1e-9


def test_scores_of_empty_tables_and_clashing_columns(spark):
    schema = "doc_id long, text string, block int, kind string, key int, code int, score int"
    none = spark.createDataFrame([], schema)
    assert ppm.score_documents(none).count() == 0
    rows = spark.createDataFrame([(1, None, 1, "a", 2, 3, 4), (None, "x y", 1, "a", 2, 3, 4)] * 2, schema)
    assert ppm.score_documents(rows).count() == 4


def test_kneser_ney(docs, labels):
    keys, n = np.unique(kneser_ney.sequences(np.frombuffer(b"the cat sat on the mat " * 9, np.uint8)), return_counts=True)
    model = kneser_ney.KneserNey(keys, n)
    context = int.from_bytes(b"the", "big") << 8
    assert abs(np.exp2(model.log2(context + np.arange(256))).sum() - 1) < 1e-6
    found = kneser_ney.classify(docs, labels)
    assert found.count() == docs.count()
    assert found.where("perplexity IS NULL AND kept").count() == 0
    assert kneser_ney.classify(docs, labels.limit(0)).where("n_bytes > 0 AND NOT kept").count() == 0


def test_kneser_ney_learns_from_all_trusted_documents(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(6000).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 2 AS INT) AS toxic")
    labels = labels.unionByName(labels).withColumn("toxic", F.when(F.col("doc_id") % 2 == 1, 0))
    ids = kneser_ney.trusted_ids(labels)
    assert ids.count() == 6000
    model = kneser_ney.train(docs, ids)
    seen = {int(k) for k in model.levels[0][0]}
    for i in range(5000):
        assert int.from_bytes(f"text {i}"[-4:].encode(), "big") in seen
