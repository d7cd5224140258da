"""Divergence rules, whitening and fill-in-middle against brute force, with nulls, empty and long texts, repeats and clashes."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chronofold.llm import divergence, fim, registry, whitening

RND = random.Random(11)
SF = "/root/testdata/sf0.001"
WORDS = ["river", "stone", "bridge", "slowly", "green", "the", "of", "and", "über", "walked"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def prose(n, mark=""):
    return " ".join(RND.choice(WORDS) + (str(RND.randrange(400)) if RND.random() < 0.5 else "") + mark for _ in range(n))


LONG = prose(50_000)
TEXTS = [None, "", " \n\t", "one", "a\nb\na\n\nb\n \nb", "x y z " * 30, LONG, " é wide \x1c\x85 blanks", "ends with blanks  \v\f\r\n", "has <P> mark", "<S", "M>tail", "<<P", prose(80, "&&&"), prose(120, "&&&"), "😀 " * 12]


def table(spark, rows):
    schema = "doc_id long, text string, lang string, t string, w string, n long, row string, id int, form string, kept string, common string"
    return spark.createDataFrame([(i, x, "aa", "t", "w", 7, "r", 1, "f", "k", "c") for i, x in rows], schema).repartition(3)


@pytest.fixture(scope="module")
def rows():
    docs = list(enumerate(TEXTS)) + [(100 + k, prose(RND.randrange(30, 200))) for k in range(60)]
    return docs + [(6, LONG), (100, docs[-60][1]), (None, None), (None, "null id of a text that is short")]


def base(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    often = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if often[x] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def jensen(p, q):
    out = 0
    for a, b in zip(p, q):
        out += (a * math.log2(2 * a / (a + b)) if a > 0 else 0) + (b * math.log2(2 * b / (a + b)) if b > 0 else 0)
    return math.sqrt(max(0, out / 2))


def classes(text):
    text = text or ""
    of = ["[A-Z]", "[0-9]", r"[.,;:!?'\"()\-]", r"[#$%&*+/<=>@\[\\\]^_`{|}~]", r"[^\x00-\x7F]"]
    out = [len(re.findall(p, text)) for p in of] + [sum(c in divergence.BLANKS for c in text)]
    return out + [len(text) - sum(out)]


def brute_verdicts(texts):
    """(word distance, class distance) of each text, all of one language."""
    words = [WORD.findall(x or "") for x in texts]
    long = [k for k, w in enumerate(words) if len(w) >= 50]
    scale, sums, total, shape = divergence.SCALE, Counter(), 0, np.zeros(7)
    for k in long:
        n = len(words[k])
        total += n * (scale // n)
        for x in words[k]:
            sums[x.lower()] += scale // n
        shape += [scale * c // len(texts[k]) for c in classes(texts[k])]
    top = sorted(((-s, x) for x, s in sums.items() if s >= 0.001 * total and re.search(r"[^\W\d_]", x)))[:32]
    q = [-s / total for s, _ in top]
    out = {}
    for k in long:
        own = Counter(x.lower() for x in words[k])
        p = [own[x] / len(words[k]) for _, x in top]
        out[k] = jensen([*p, 1 - sum(p)], [*q, 1 - sum(q)]), jensen([c / len(texts[k]) for c in classes(texts[k])], shape / shape.sum())
    return out


def test_divergence_matches_brute_force(spark, rows):
    got = divergence.judge(table(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = [x for _, x in rows]
    far = brute_verdicts(texts)
    want = []
    for k, (i, x) in enumerate(rows):
        n, *_, failed = base(x)
        bad = k in far and (far[k][0] > 0.22 + 1.4 / math.sqrt(n) or far[k][1] > 0.15 + 0.8 / math.sqrt(n))
        want.append((i, *base(x), not failed and not bad))
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:8] for r in got), key=key) == sorted(want, key=key)
    near = {r.doc_id: r for r in got}
    for k, (w, c) in far.items():
        if rows[k][0] is not None:
            assert near[rows[k][0]].word_distance == pytest.approx(w, abs=1e-9) and near[rows[k][0]].class_distance == pytest.approx(c, abs=1e-9)
    assert not near[14].kept and not near[14].base_failed and near[101].kept


def test_kept_rows_keep_their_columns(spark, rows):
    docs = table(spark, rows)
    got = divergence.keep_good(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in divergence.judge(docs).where("kept").collect()}
    assert divergence.judge(docs.where("doc_id < 0")).count() == 0
    assert divergence.judge(docs, lang_col=None).where("kept").count() == got.count()


def test_a_language_without_a_reference_is_judged_by_the_base_rules(spark):
    docs = spark.createDataFrame([(1, prose(80, "&&&"), None), (2, prose(80), "zz")], "doc_id long, text string, lang string")
    assert [r.kept for r in divergence.judge(docs).orderBy("doc_id").collect()] == [True, True]
    assert [r.word_distance for r in divergence.judge(docs).collect()] == [None, None]


def test_no_python_in_the_plan_of_the_rules(spark):
    plan = registry.op11_divergence(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_most_labelled_junk_goes_and_clean_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = registry.op11_divergence(spark, "/root/testdata/sf0.01").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")), F.avg((F.col("kept") | F.col("base_failed")).cast("int"))).collect()
    share = {r[0]: r[1:] for r in got}
    assert share[0][0] < 0.1 and share[1][1] > 0.99


# whitening


def whole(x):
    return np.floor(64 * np.asarray(x, float)).astype(np.int64) + 1_000_000


def check_whitening(spark, vectors, k=16, **more):
    """Compare whiten() with numpy on plain lists; the rows that took part."""
    data = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in data], "vec_id long, embedding array<double>, x string, n int").repartition(4)
    got = whitening.whiten(df, k=k, **more).collect()
    good = [(i, v) for i, v in data if v and all(c is not None and math.isfinite(c) for c in v)]
    x = whole([v for _, v in good])
    distinct = np.unique(x, axis=0)
    n, s = len(distinct), distinct.sum(0)
    c = distinct - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    some = min(k, int((e > e[0] * 1e-12).sum()))
    table = {(r.vec_id, r.component): r for r in got}
    assert len(table) == len(got) == len(good) * some
    w = (x - s / n) @ u[:, :some] / np.sqrt(e[:some])
    mine = np.array([[table[i, j + 1].whitened for j in range(some)] for i, _ in good])
    assert np.abs(mine * np.sign((mine * w).sum(0)) - w).max() < 1e-7
    assert [table[i, 1].deviation for i, _ in good] == [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    assert {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    np.testing.assert_allclose([table[good[0][0], j + 1].explained for j in range(some)], e[:some] / e.sum(), rtol=1e-9)
    return good


def test_whitening_of_a_steep_spectrum_needs_no_full_basis(spark):
    rng = np.random.default_rng(1)
    z = (rng.standard_normal((400, 90)) * 40 * np.exp(-np.arange(90) / 1.5)) @ np.linalg.qr(rng.standard_normal((90, 90)))[0]
    check_whitening(spark, z.tolist(), k=6)
    rows = whitening.whole(spark.createDataFrame([(v,) for v in z.tolist()], "v array<double>"), "v", 64.0).distinct()
    assert not whitening.fit(rows, 6, oversample=20).full


def test_whitening_of_a_flat_spectrum_grows_to_the_full_basis(spark):
    z = np.random.default_rng(2).standard_normal((300, 40))
    check_whitening(spark, z.tolist())
    rows = whitening.whole(spark.createDataFrame([(v,) for v in z.tolist()], "v array<double>"), "v", 64.0).distinct()
    assert whitening.fit(rows).full


def test_whitening_leaves_out_what_takes_no_part(spark):
    rng = np.random.default_rng(3)
    z = rng.standard_normal((50, 5)).tolist()
    odd = [None, [], [None] * 5, [1.0, math.nan, 0, 0, 0], [math.inf, 0, 0, 0, 0]]
    assert len(check_whitening(spark, z + odd + [z[0]] * 40)) == 90


def test_whitening_of_flat_or_no_vectors(spark):
    df = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(df([])).collect() == [] and whitening.whiten(df([(1, None)])).collect() == []
    assert whitening.whiten(df([(1, [0.5, 1.0])] * 3)).collect() == []
    assert whitening.whiten(df([(k, [0.5, float(k)]) for k in range(4)] + [(9, [1.0])])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert {(r.vec_id, r.component) for r in whitening.whiten(df([(k, [0.5, float(k)]) for k in range(4)] + [(9, [1.0]), (None, [0.5, 9.0])])).collect()} == {(0, 1), (1, 1), (2, 1), (3, 1), (None, 1)}


def test_deviations_beyond_64_bits_are_null():
    s = np.array([3, 2**70], dtype=object)
    assert whitening._deviations(3, s, np.array([[1, 2**40]])) == [None]
    assert whitening._deviations(3, np.array([3, 6], dtype=object), np.array([[1, 3]])) == [9]


# fill-in-middle


def brute_fim(i, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return len(units), form, len(p), len(m), out


def test_fim_matches_brute_force_and_restores(spark, rows):
    more = [(1000 + k, "".join(RND.choice(["a", "é", "😀", " ", "\n", "\t", "<", "P", "S", "M", ">", " "]) for _ in range(RND.randrange(40)))) for k in range(800)]
    docs = table(spark, rows + more)
    out = fim.transform(docs)
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.text) for r in out.collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(((i, *brute_fim(i, x)) for i, x in rows + more), key=key)
    assert set(out.columns) == {*docs.columns, "n", "form", "prefix_chars", "middle_chars"}
    back = fim.restore(out).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=key) == sorted(((i, x or "") for i, x in rows + more), key=key)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    digests = [(r.doc_id, r.output_sha256, r.restored_sha256) for r in fim.digests(docs).collect()]
    assert sorted(digests, key=key) == sorted(((i, sha(brute_fim(i, x)[-1]), sha(x or "")) for i, x in rows + more), key=key)
    assert fim.transform(docs.where("doc_id < 0")).count() == 0


def test_fim_blocks_do_not_change_the_result(spark, rows, monkeypatch):
    texts = [x or "" for _, x in rows]
    whole, edges = "".join(texts).encode(), np.cumsum([0] + [len(x.encode()) for x in texts])
    h = np.random.default_rng(5).integers(0, 1 << 32, (len(texts), 4))
    one = fim.Cut(np.frombuffer(whole, np.uint8), edges, h)
    for k, x in enumerate(texts):
        data = np.frombuffer(x.encode(), np.uint8)
        alone = fim.Cut(data, np.array([0, len(data)]), h[k : k + 1])
        assert (alone.n[0], alone.form[0], alone.prefix_chars[0], alone.middle_chars[0]) == (one.n[k], one.form[k], one.prefix_chars[k], one.middle_chars[k])


@pytest.mark.parametrize("name", ["op11_divergence", "op13_fim"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    got = registry.queries()[name](spark, SF)
    assert got.columns == want.columns
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want.fetchall(), key=key)
