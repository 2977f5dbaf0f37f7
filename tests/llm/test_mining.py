"""Hard negatives, phrase collocations and decontamination against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from notaflow.llm import collocations, decontaminate, hard_negatives
from tests.llm.brute import lower


# ------------------------------------------------------------------ hard negatives
def plain_negatives(rows, n_pos=5, n_neg=10, low=30, high=90):
    ints = [(i, c, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, c in rows
            if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _, _ in ints if i % 100 == 0}):
        label, v = min((c, v) for i, c, v in ints if i == q)
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i, c) for i, c, w in ints if i != q)
        for s, p, _ in [x for x in scored if x[2] == label][:n_pos]:
            far = [(t, i) for t, i, c in scored if c != label and -low * s <= -100 * t <= -high * s][:n_neg]
            out += [(q, p, r + 1, i, -s, -t) for r, (t, i) in enumerate(far)]
    return Counter(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, c, "x", 1, b"") for i, v, c in rows],
                                 "vec_id long, embedding array<float>, label int, id string, n long, matrix binary")


@pytest.mark.parametrize("shard_rows,block", [(8192, 256), (40, 2)])
def test_hard_negatives(spark, monkeypatch, shard_rows, block):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", block)
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 1, 24)
    rows = [(i, [float(x) for x in (centre + rng.normal(0, 1, 24)).astype(np.float32)], int(i % 4)) for i in range(401)]
    rows += [(500 + i, rows[7][1], i % 3) for i in range(15)]  # ties
    rows += [(600, None, 1), (601, [1.0, None], 1), (602, [float("nan")] * 24, 1), (700, [float("inf")] * 24, 1), (800, [], 2),
             (801, [2.0, 3.0], 2), (None, [1.0] * 24, 0), (900, [0.0] * 24, 0), (1000, rows[7][1], None), (1100, [-1.0] * 24, 9)]
    rows += [rows[4], rows[8], rows[9], rows[0]]  # repeated rows
    got = hard_negatives.hard_negatives(vectors(spark, rows).repartition(3), "id % 100 = 0").collect()
    want = plain_negatives(rows)
    assert Counter(tuple(r) for r in got) == want and len(want) > 100


def test_hard_negatives_few(spark):
    rows = [(0, [1.0], 1), (3, [2.0], 1), (4, [1.0], 2), (5, [3.0], 2)]
    df = vectors(spark, rows)
    got = [tuple(r) for r in hard_negatives.hard_negatives(df, "id % 100 = 0").collect()]
    assert got == [(0, 3, 1, 4, 256 * 512, 256 * 256)]
    assert hard_negatives.hard_negatives(df.where("vec_id < 0"), "id % 100 = 0").count() == 0
    assert hard_negatives.hard_negatives(df, "id > 100").count() == 0


def test_vertical_scan_beyond_doubles():
    rng = np.random.default_rng(5)
    columns = np.array([[int(x) for x in rng.integers(-2**45, 2**45, 30)] for _ in range(12)], object)
    anchor = np.array([int(x) for x in rng.integers(-2**45, 2**45, 12)], object)
    full = anchor @ columns
    rows, score = hard_negatives.vertical_scan(columns, columns.min(axis=1), columns.max(axis=1), anchor,
                                               np.arange(30) % 2 == 0, hard_negatives.best(3))
    want = sorted(range(0, 30, 2), key=lambda i: -full[i])[:3]
    assert [int(rows[i]) for i in hard_negatives._top(score, rows, 3)] == want
    assert all(score[j] == full[i] for j, i in enumerate(rows))


# ------------------------------------------------------------------ phrases
def plain_phrases(rows, least, max_words=5, top=2000, percent=100):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for m in range(1, max_words + 1):
                for i in range(len(w) - m + 1):
                    f[lang or "und"][tuple(w[i:i + m])] += 1
    out = set()
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in cand.items()):
                continue
            s, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), k))
        for r, (s, a, p, k) in enumerate(sorted(scored)[:top]):
            w = tuple(p.decode().split(" "))
            out.add((lang, r + 1, p.decode(), k, -a, count[w[:k]], count[w[k:]], n[lang], -s))
    return out


def phrase_docs(spark):
    rng = random.Random(3)
    common = "the of a to in new york city hall café São".split()

    def text(n):
        return "".join(rng.choice(common) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r\n"]) for _ in range(n))

    passage = "We the People of the United States, in Order to form a more perfect Union"
    rows = [(text(rng.randint(0, 300)), rng.choice(["en", "en", "fr", None])) for _ in range(80)]
    rows += [(f"{text(20)} {passage} {text(20)}", "en") for _ in range(30)]
    rows += [(rows[3][0], "en")] * 25 + [(None, "en"), ("", "fr"), (" \n\t", None), ("aa " * 9000, "en"),
                                         ("x" * 5000 + " " + "y" * 300, "en"), ("a\x1cb a\x00b 日本 🎉 " * 30, "e n")]
    rows += [("one two " * 12, "e\x01n"), ("one two " * 12, "e n")]
    return rows, spark.createDataFrame([(i, t, g, "x", 1, 2) for i, (t, g) in enumerate(rows)],
                                       "doc_id long, text string, lang string, phrase string, f long, weight long").repartition(4)


@pytest.mark.parametrize("least,top,percent", [(20, 2000, 100), (20, 7, 100), (12, 2000, 80)])
def test_collocations(spark, least, top, percent):
    rows, df = phrase_docs(spark)
    got = collocations.collocations(df, min_count=least, top=top, percent=percent).collect()
    want = plain_phrases(rows, least, top=top, percent=percent)
    assert {tuple(r) for r in got} == want and len(got) == len(want) and len(want) > 15


def test_small_slices_and_full_filter(spark, monkeypatch):
    """Chunks cut short, many slices, and a filter that is nearly full: the counts are the same."""
    rows, df = phrase_docs(spark)
    monkeypatch.setattr(collocations, "LONGEST", 50)
    monkeypatch.setattr(collocations, "_SLICE", 3000)
    monkeypatch.setattr(collocations, "FILTER_BITS", 8)
    monkeypatch.setattr(collocations, "SEGMENT_BITS", 4)
    got = collocations.collocations(df, min_count=20).collect()
    assert {tuple(r) for r in got} == plain_phrases(rows, 20)


def test_parse_assigns_each_word_once(spark):
    rows, df = phrase_docs(spark)
    d = collocations.parse(df.where("text IS NOT NULL").fillna("und", "lang"), 4).collect()
    words = sum(len(re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", t or "")) for t, _ in rows)
    assert sum(r.owned * r.weight for r in d) == words
    assert max(r.weight for r in d if len(r.chunk) > 20) >= 25  # copies are one row


def test_collocations_of_nothing(spark):
    _, df = phrase_docs(spark)
    assert collocations.collocations(df.where("doc_id < 0")).count() == 0
    assert collocations.collocations(df, min_count=10**6).count() == 0


def test_numbers_beyond_64_bits(spark, monkeypatch):
    """1000 * a * n passes 64 bits: counts are blown up on their way."""
    df = spark.createDataFrame([("a b", "en"), ("a c", "en")], "text string, lang string")
    plain, huge = collocations.parse, 10**14
    monkeypatch.setattr(collocations, "parse", lambda *a: plain(*a).withColumn("weight", F.col("weight") * huge))
    got = {(r.phrase, r.l, r.r, r.n, r.score) for r in collocations.collocations(df).collect()}
    assert got == {("a b", 2 * huge, huge, 4 * huge, 2000), ("a c", 2 * huge, huge, 4 * huge, 2000)}


# ------------------------------------------------------------------ decontamination
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_leaks(docs, items, window=10):
    patterns = defaultdict(set)
    for item, text in items:
        w = WORD.findall(lower(text))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            patterns[tuple(w[i:i + window])].add(item)
    out = Counter()
    for d, text in docs:
        at = [(m[0], m.span()) for m in WORD.finditer(lower(text))]
        w, hit, found = [x for x, _ in at], set(), set()
        for size in {len(p) for p in patterns}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in patterns:
                    hit.update(range(i, i + size))
                    found |= patterns[tuple(w[i:i + size])]
        spans = []
        for i in sorted(hit):
            if i - 1 in hit:
                spans[-1] = (spans[-1][0], at[i][1][1])
            else:
                spans.append(at[i][1])
        out[d, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None)), tuple(spans)] += 1
    return out


def leak_tables(spark, corpus):
    rng = random.Random(6)
    items = [(i, " ".join(corpus[i][1].split()[:rng.randint(1, 40)])) for i in range(0, 50, 3)]
    items += [(200, "What is the Capital of France? Paris, of course: it has been so since the 10th century!"),
              (201, "What is the capital of france"), (202, None), (203, ""), (204, "?!"), (None, "Nobody owns this one"),
              (205, "aa " * 30), (3, "another text of item three"), (206, "日本 🎉"), (207, "X" * 2000 + " long")]
    items.append(items[0])
    docs = [(d, t) for d, t, _ in corpus]
    docs += [(300, "Well: WHAT is the capital\nof France?  Paris - of course; it has been so (since the 10th century)."),
             (301, "é🎉 so What   is the capital of France"), (302, "nobody owns THIS one. Nobody owns this, one!"),
             (303, "naïve 日本-🎉 日本"), (304, None), (305, "x" * 2000 + "\tLONG"), (306, "what is the capital of"), (None, "aa " * 12)]
    df = spark.createDataFrame([(d, t, "x", b"x", 1) for d, t in docs],
                               "doc_id long, text string, pattern string, hit binary, n_words long").repartition(3)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, item string")
    return docs, items, df, bench


@pytest.mark.parametrize("window,shard_bytes", [(10, 64 << 20), (4, 64 << 20), (10, 60_000)])
def test_contamination(spark, corpus, window, shard_bytes):
    """Also with as many automata as a bound below the benchmark's size asks for."""
    docs, items, df, bench = leak_tables(spark, corpus)
    got = decontaminate.contamination(df, bench, window=window, shard_bytes=shard_bytes).collect()
    want = plain_leaks(docs, items, window)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), tuple((s.begin, s.end) for s in r.spans)) for r in got) == want
    assert sum(1 for k in want if k[2]) > 20


def test_contamination_of_nothing(spark, corpus):
    docs, _, df, bench = leak_tables(spark, corpus)
    none = bench.where("item_id < 0")
    assert decontaminate.contamination(df.where("doc_id < 0"), bench).count() == 0
    got = decontaminate.contamination(df, none).collect()
    assert len(got) == len(docs) and all(r.n_hit == 0 and r["items"] == [] and r.spans == [] for r in got)


def test_questions_and_answers_apart(spark):
    bench = spark.createDataFrame([("q7", "one two three", "four five")], "name string, question string, answer string")
    docs = spark.createDataFrame([(1, "three four"), (2, "One, two; three: four five")], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench, item_col="name", item_texts=("question", "answer")).collect()}
    assert got[1].n_hit == 0 and got[2].n_hit == 5 and got[2]["items"] == ["q7"]
    assert [(s.begin, s.end) for s in got[2].spans] == [(0, 26)]
