"""BPE, languages, quality, toxicity, archives."""

import base64
import hashlib
import random
import time

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from chronofold.llm import bpe, labelled, langid, quality, toxicity, warc
from chronofold.llm.registry import VOCABULARY
from chronofold.llm.session import shared_dir

TEXTS = [None, "", " ", "a  b", " lead", "trail ", "It's  I'LL\n\n we'll", "é́ ñ ü 東京 😀", "aaaaaaaaaaaaaaaa aaaa", "<|endoftext|> x<|endoftext|><|endoftext|>", "x" * 3000, "a\nb \n c\t\td", "word, word. (word) 12,345.67!", "\x1c\x85　a​ b"]


@pytest.fixture(scope="module")
def public():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(VOCABULARY)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_public_tokenizer(spark, public):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)] + [(1, "again", 0)], "doc_id long, text string, n_tokens long")
    got = bpe.encode_documents(df, VOCABULARY).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        if r.doc_id == 1 and r.n_tokens:
            continue
        text = TEXTS[r.doc_id] or ""
        ids = public.encode(text, add_special_tokens=False).ids
        assert list(r.token_ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(public.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_documents(df.limit(0), VOCABULARY).count() == 0


def test_bpe_random_text_and_ids(public):
    rnd, mine = random.Random(1), bpe.ByteBPE(open(VOCABULARY, "rb").read())
    texts = ["".join(rnd.choice("ab  'st\n,.19éß東😀 ") for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    for ids, text in zip(mine.encode(texts), texts):
        assert ids.tolist() == public.encode(text, add_special_tokens=False).ids
        assert mine.decimals(ids)[0].tobytes().decode() == "".join(f"{i}," for i in ids.tolist())
    for _ in range(100):  # ids that no text gives
        ids = [rnd.randrange(50257) for _ in range(8)]
        assert mine.decode(np.array(ids)) == public.decode(ids, skip_special_tokens=False)


def test_bpe_memory_is_bounded(monkeypatch, public):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    mine = bpe.ByteBPE(open(VOCABULARY, "rb").read())
    for n in range(20):
        text = " ".join(f"w{n}x{k} the" for k in range(4))
        assert next(mine.encode([text])).tolist() == public.encode(text, add_special_tokens=False).ids
    assert len(mine.young) + len(mine.old) < 60


def test_bpe_pretokens_equal_the_pattern():
    rnd, mine = random.Random(2), bpe.ByteBPE(open(VOCABULARY, "rb").read())
    parts = ["a", "B", " ", " ", "'", "s", "t", "re", "ve", "ll", "m", "d", "\n", "\t", "1", "²", "é", "東", "😀", ".", "\u3000", "\x85", "\x1c", "\u200b", "\u0301"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 30))) for _ in range(3000)]
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    edges = np.cumsum([0, *map(len, texts)])
    want = [edges[k] + m.start() for k, t in enumerate(texts) for m in regex.finditer(bpe.PATTERN, t)]
    assert mine.cut(codes, edges).tolist() == want


def test_bpe_long_words_and_long_texts(monkeypatch, public):
    rnd, mine = random.Random(3), bpe.ByteBPE(open(VOCABULARY, "rb").read())
    monkeypatch.setattr(bpe, "LONG", 16)
    monkeypatch.setattr(bpe, "SEAM", 2)
    monkeypatch.setattr(bpe, "BATCH_CHARS", 40)
    for letters in ("a", "ab", "etaoin", "abcdefghijklmnopqrstuvwxyz", "aé", "東京大学"):
        word = "".join(rnd.choice(letters) for _ in range(2000))
        text = " ".join(word[i : i + rnd.randint(1, 90)] for i in range(0, 2000, 50)) + "<|endoftext|>" + word
        for t in (word, text):
            assert next(mine.encode([t])).tolist() == public.encode(t, add_special_tokens=False).ids
    began = time.perf_counter()
    monkeypatch.undo()
    word = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(80_000))
    assert next(mine.encode([word])).tolist() == public.encode(word, add_special_tokens=False).ids
    assert time.perf_counter() - began < 10


def languages(n):
    rnd = random.Random(5)
    words = {"aa": ["kara", "tomo", "shi", "naka"], "bb": ["zwolf", "pfeil", "schnur", "grund"]}
    return [(i, " ".join(rnd.choice(words[k]) for _ in range(rnd.randint(3, 200))), k) for i in range(n) for k in [rnd.choice("ab") * 2]]


def test_languages_on_held_out_rows(spark):
    rows = languages(400) + [(900, None, "aa"), (901, "", None), (902, "12 !?", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df.where(labelled.crc_mod("doc_id", 4) != 2))
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    held = {r[0] for r in df.where(labelled.crc_mod("doc_id", 4) == 2).select("doc_id").collect()} - {900, 901, 902}
    assert np.mean([got[i].lang_pred == k for i, _, k in rows if i in held]) >= 0.97
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.train(df.where("lang IS NULL")) is None
    assert {r.lang_pred for r in langid.predict(df, None).collect()} == {"und"}


def test_table_of_pairs_equals_plain_convolution():
    net = langid.ByteCNN(["x", "y"]).compile()
    x = np.random.default_rng(0).integers(0, 256, (3, langid.WINDOW))
    for w, got in zip(net.weights, net.responses(x)):
        n = langid.WINDOW - len(w) + 1
        assert np.allclose(got, sum(w[j][x[:, j : j + n]] for j in range(len(w))), atol=1e-5)


def corpus(n, seed):
    rnd, rows, labels = random.Random(seed), [], []
    for i in range(n):
        bad, rude = rnd.random() < 0.3, rnd.random() < 0.3
        words = [rnd.choice(["river", "stone", "bridge", "walks", "slowly", "green", "hill"]) + rnd.choice("abcdefgh") for _ in range(rnd.randint(30, 90))]
        if rude:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(["grolk", "snirp", "blurgh"]))
        text = " ".join(w + ("&&&" if bad else "") for w in words)
        rows.append((i, text))
        labels.append((i, 0 if bad else 1, 1 if rude else 0))
    return rows + [(n, None), (n + 1, "")], labels


def test_quality_and_toxicity_on_held_out_rows(spark):
    rows, labels = corpus(600, 3)
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = labelled.crc_mod("doc_id", 3) == 1
    model = quality.train(df, lab.where(~held))
    truth = {i: (q, t) for i, q, t in labels}
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    wrong = [i for i in truth if (got[i] >= 0.5) != (truth[i][0] == 1)]
    assert len(got) == 602 and len(wrong) <= 6 and all(0 <= s <= 1 for s in got.values())
    assert sum(1 for _ in model.rules) < 60
    kept = quality.keep_good(df.withColumn("chars", F.lit("clash")), model)
    assert kept.columns == ["doc_id", "text", "chars"] and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s >= 0.5}
    tox = toxicity.train(df, lab.where(~held))
    score = {r.doc_id: r.score for r in toxicity.score(df, tox).collect()}
    wrong = [i for i in truth if (score[i] >= 0.3) != (truth[i][1] == 1)]
    assert len(score) == 602 and len(wrong) <= 12 and score[600] == score[601]


def test_toxicity_is_fitted_on_whole_texts(spark, monkeypatch):
    """Toxic words that only stand beyond the first 8000 characters are learnt, and a bound on bytes drops whole rows."""
    rnd = random.Random(8)
    plain = lambda n: [rnd.choice(["river", "stone", "bridge", "walks", "slowly", "green", "hill"]) + rnd.choice("abcdefgh") for _ in range(n)]
    rows = [(i, " ".join(plain(1500) + (["grolk", "snirp", "blurgh"] if i % 3 == 0 else []) + plain(5)), int(i % 3 == 0)) for i in range(90)]
    assert min(t.find("grolk") for _, t, y in rows if y) > 8000
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert b"grolk" in model.toxic
    assert all((r.score >= 0.3) == (r.doc_id % 3 == 0) for r in toxicity.score(df, model).collect())
    seen = []
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", sum(len(t) for _, t, _ in rows) // 2)
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, shares: seen.append((texts, shares)))
    toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    texts, shares = seen[0]
    assert 30 < len(texts) < 60 and set(texts) <= {t for _, t, _ in rows} and 0 < shares[0] < 1 and 0 < shares[1] < 1


def test_rules_mean_the_same_in_numpy_and_spark(spark):
    rows, labels = corpus(200, 4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stats = quality.statistics(df, "text", ("doc_id",))
    model = quality.train(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    x = np.array([r[1:] for r in stats.orderBy("doc_id").collect()], float)
    z = model.intercept + sum(w * r.holds(x) for r, w in model.rules)
    got = [r.score for r in quality.score(df, model).orderBy("doc_id").collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-z)))


def test_models_without_labels(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score >= 0.5 for r in quality.score(df, quality.train(df, none)).collect()} == {True}
    assert {r.score < 0.3 for r in toxicity.score(df, toxicity.train(df, none)).collect()} == {True}
    assert quality.score(df.limit(0), quality.train(df, none)).count() == 0


def test_archives_round_trip(spark):
    pages = [(1, None, None), (2, "http://x y\nz", ""), (3, "u", "é" * 100000), (4, "u", "é" * 100000), (5, "v", "P*M\x18\0\0\0\0" * 3), (6, "w", "<p>one</p>"), (6, "w", "<p>one</p>"), (7, None, "<p>one</p>")]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, payload string").repartition(3)
    path = shared_dir(spark, "warc")
    warc.write(df, path)
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in warc.read(spark, path, with_payload=True).collect())
    last = {}
    for i, _, h in pages:
        last[h or ""] = max(i, last.get(h or "", i))
    want = []
    for i, _, h in pages:
        raw, first = (h or "").encode(), last[h or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((i, len(raw), digest, "response" if first == i else "revisit", None if first == i else first, raw if first == i else None))
    assert got == sorted(want)
    urls = {r.url for r in warc.read(spark, path).collect()}
    assert "http://x y\nz" in urls and "about:blank" in urls
    empty = shared_dir(spark, "warc")
    warc.write(df.limit(0), empty)
    assert warc.read(spark, empty).count() == 0
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect() if r.length]
    assert files and all(int.from_bytes(f[:4], "little") == warc.DICTIONARY_MAGIC for f in files)


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    path = shared_dir(spark, "warc")
    warc.write(df, path, min_revisit_bytes=3)
    assert {r.page_id: r.refers_to for r in warc.read(spark, path).collect()} == {1: None, 2: None, 3: 4, 4: None}
