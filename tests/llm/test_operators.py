"""The other operators against brute force, held-out labels and planted cases."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR

import corpus_pipeline
from recordloom.llm import (
    fingerprint, kneser_ney, language_id, mixing, neighbours, queries, secrets, toxicity,
)
from recordloom.llm.hilbert import hilbert_keys

from .conftest import ODD_TEXTS


def documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return {r.doc_id: r for r in rows}


# --- nearest neighbours -------------------------------------------------------------


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    keys = hilbert_keys(grid, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def exact_neighbours(vectors, k):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], float)
    for q in np.flatnonzero(ids % 20 == 0):
        score = (x * x[q]).sum(1)
        order = [j for j in np.lexsort((ids, -score)) if j != q][:k]
        yield int(ids[q]), [int(ids[j]) for j in order]


def recall(got, expected):
    found = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append(r.vec_id)
    pairs = [(set(found[q]), set(e)) for q, e in expected]
    assert all(len(f) == len(e) for f, e in pairs)
    return sum(len(f & e) for f, e in pairs) / sum(len(e) for _, e in pairs)


def test_neighbours_of_all_queries(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = queries.QUERIES["op1_neighbours"](spark, SF_DIR).collect()
    assert recall(got, list(exact_neighbours([tuple(r) for r in rows], 20))) >= 0.9


def test_neighbours_with_narrow_windows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAST_WINDOW", 1)
    random = np.random.default_rng(5)
    centres = random.normal(size=(40, 16))
    vectors = [(i, (centres[i % 40] + random.normal(size=16) * 0.2).tolist()) for i in range(4000)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.filter("vec_id % 20 = 0"), k=10).collect()
    assert recall(got, list(exact_neighbours(vectors, 10))) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(20, [1.0, 0.0]), (3, [2.0, 0.0]), (2, [2.0, 0.0]), (5, [-1.0, 0.5]), (40, [0.0, 0.0]), (7, None),
               (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]), (11, [1.0]), (None, [1.0, 1.0]), (60, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.filter("vec_id % 20 = 0"), k=20).collect()
    assert sorted(map(tuple, got)) == [(20, 1, 2, 2.0), (20, 2, 3, 2.0), (20, 3, 5, -1.0)]
    assert neighbours.nearest(df.limit(0), df.limit(0)).collect() == []


# --- fingerprints ---------------------------------------------------------------------


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check_fingerprints(rows, got):
    got = {r.doc_id: r for r in got}
    rows = sorted(rows)
    errors, prints = [], {}
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, got[i].fingerprint) == got[i].fingerprint
        if len(shingles(text)) > 20:
            errors.append(got[i].near_edited - likeness(shingles(text), shingles(edited)))
            errors.append(got[i].near_next - likeness(shingles(text), shingles(after)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_fingerprints_of_all_documents(spark):
    rows = [(i, r.text) for i, r in documents(spark).items()]
    check_fingerprints(rows, queries.QUERIES["op2_fingerprint"](spark, SF_DIR).collect())


def test_fingerprints_of_odd_texts(frame):
    long = " ".join(f"w{i}" for i in range(300))
    rows = list(enumerate([*ODD_TEXTS, long, long + " tail"]))
    check_fingerprints(rows, fingerprint.edited_neighbours(frame(rows)).collect())


def test_fingerprints_of_few_rows(frame):
    (row,) = fingerprint.edited_neighbours(frame([(4, "a b c d e f")])).collect()
    assert row.near_next == 1.0
    assert fingerprint.edited_neighbours(frame([])).collect() == []
    got = fingerprint.edited_neighbours(frame([(None, "x" * 8), (1, "y" * 8), (1, "y" * 8)])).collect()
    assert len(got) == 3


# --- language model -------------------------------------------------------------------


def test_language_model(spark):
    docs = documents(spark)
    got = {r.doc_id: r for r in queries.QUERIES["op3_kneser_ney"](spark, SF_DIR).collect()}
    words = {i: [*(r.text or "").encode().lower().split(), None] for i, r in docs.items()}
    trained = [i for i in words if zlib.crc32(str(i).encode()) % 10]
    uni = collections.Counter(w for i in trained for w in words[i])
    pairs = collections.Counter(p for i in trained for p in zip([0, *words[i]], words[i]))
    after = collections.Counter(w for _, w in pairs)
    of_u = collections.defaultdict(list)
    for (u, _), c in pairs.items():
        of_u[u].append(c)
    n, v, t = uni.total(), len(uni), len(pairs)
    d = [0, *kneser_ney._discounts([sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)])]
    e = [0, *kneser_ney._discounts([sum(c == k for c in after.values()) for k in (1, 2, 3, 4)])]
    rest = sum(e[min(c, 3)] for c in after.values()) / t
    share = {u: sum(d[min(c, 3)] for c in cs) / sum(cs) for u, cs in of_u.items()}
    total = {u: sum(cs) for u, cs in of_u.items()}

    def alone(w):
        return max(after[w] - e[min(after[w], 3)], 0) / t + rest / (v + 1)

    def p(u, w):
        if u not in total:
            return alone(w)
        c = pairs[u, w]
        return max(c - d[min(c, 3)], 0) / total[u] + share[u] * alone(w)

    assert sum(map(alone, uni)) + rest / (v + 1) == pytest.approx(1)
    for i, ws in words.items():
        row = got[i]
        assert (row.n_tokens, row.train_tokens) == (len(ws), n)
        assert row.n_known == sum(w in uni for w in ws)
        assert row.base_score == pytest.approx(sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        assert row.score == pytest.approx(sum(math.log10(p(u, w)) for u, w in zip([0, *ws], ws)))


def test_language_model_of_odd_texts(frame):
    docs = frame(list(enumerate(ODD_TEXTS)))
    model = kneser_ney.train(docs)
    rows = kneser_ney.score(docs, model, ["doc_id"]).collect()
    assert all(math.isfinite(r.score) and r.n_tokens >= 1 for r in rows)
    none = kneser_ney.train(frame([]))
    assert {r.score for r in kneser_ney.score(docs, none, ["doc_id"]).collect()} == {0.0}
    assert kneser_ney.score(frame([]), model, ["doc_id"]).collect() == []


# --- classifiers ----------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    got = queries.QUERIES["op4_toxicity"](spark, SF_DIR).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(toxic[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in toxic]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_disguised_insults_score(spark, frame):
    rows = [(i, f"plain words about things number {i}") for i in range(200)]
    rows += [(1000 + i, f"you are such an idiot and a moron number {i}") for i in range(100)]
    docs = frame(rows)
    model = toxicity.fit(docs.selectExpr("doc_id", "text", "int(doc_id >= 1000) AS toxic"))
    odd = frame([(1, "you are an 1diot and a m0ron"), (2, "plain words"), (3, None), (4, ""), *enumerate(ODD_TEXTS, 5)])
    scores = {r.doc_id: r.predicted for r in toxicity.score(odd, model, ["doc_id"]).collect()}
    assert scores[2] == scores[3] == scores[4] == 0
    assert toxicity.features(pa.array(["an 1diot"]), model.lexicon)[0][8] == 1
    assert toxicity.score(frame([]), model, ["doc_id"]).collect() == []
    empty = toxicity.fit(docs.limit(0).selectExpr("doc_id", "text", "1 AS toxic"))
    assert {r.score for r in toxicity.score(odd, empty, ["doc_id"]).collect()} == {0.0}


def test_languages_on_held_out_rows(spark):
    lang = {i: r.lang for i, r in documents(spark).items()}
    got = queries.QUERIES["op10_language"](spark, SF_DIR).collect()
    assert all(0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert sum(held) / len(held) > 0.9


def test_languages_of_odd_texts(spark, frame):
    docs = documents(spark)
    rows = frame([(i, r.text) for i, r in docs.items()]).selectExpr("doc_id", "text", "lang")
    one = language_id.fit(rows)
    got = {r.doc_id: r for r in language_id.identify(frame([(1, None), (2, "12 !"), (3, "é")]), one, ["doc_id"]).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und", "und", "en"]
    none = language_id.fit(rows.limit(0))
    assert {r.lang_pred for r in language_id.identify(rows, none, ["doc_id"]).collect()} == {"und"}
    assert language_id.identify(frame([]), one, ["doc_id"]).collect() == []


# --- secrets --------------------------------------------------------------------------


def test_trigram_queries():
    assert secrets.trigram_query(r"AKIA[A-Z0-9]+") == [frozenset([frozenset(["aki", "kia"])])]
    assert secrets.trigram_query(r"[0-9a-f]+") == []
    (clause,) = secrets.trigram_query(r"(cat|dogs?)x*")
    assert clause == frozenset([frozenset(["cat"]), frozenset(["dog"])])


def test_secrets_of_odd_texts(frame):
    texts = [*ODD_TEXTS, 'ñ password = "abcdefgh" token:abc', "Secret: token: abcdefgh", "AKIA" + "A" * 16 + " AKIA",
             "f" * 30 + " " + "0a" * 12, "password: x9y8z7 " * 600, "ghp_" + "a" * 36]
    got = {r.doc_id: r for r in secrets.find_secrets(frame(list(enumerate(texts))), ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        expected = []
        for rank, rule in enumerate(secrets.RULES):
            for m in re.finditer(rule.pattern, text or "", re.ASCII | (re.IGNORECASE if rule.any_case else 0)):
                if len(m.group(rule.group)) >= rule.least:
                    expected.append((m.start(), rank, rule.kind, m.end()))
        assert [tuple(s) for s in got[i].spans] == sorted(expected)
    assert secrets.find_secrets(frame([]), ["doc_id"]).collect() == []


def test_redaction(frame):
    (row,) = secrets.redact(frame([(1, "é token=abcdef123 end")])).collect()
    assert (row.text, row.n_chars) == ("é [secret] end", 14)


# --- mixing ---------------------------------------------------------------------------


def test_targets_by_resharing(spark):
    sizes = {"a": 5, "b": 1000, "c": 40, None: 7, "d": 0}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        unit = (total - sum(capped.values())) / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > 3 * sizes[s]]
        if not over:
            break
        capped |= {s: 3 * sizes[s] for s in over}
    expected = {s: capped.get(s, unit * weight[s]) for s in names}
    totals = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(totals).collect()}
    assert got == {s: pytest.approx(t) for s, t in expected.items()}


def test_mix_of_odd_rows(spark):
    rows = [(i, " w" * (i % 50), f"s{i % 4}" if i % 9 else None, "k") for i in range(600)] + [(None, None, None, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, key string")
    got = mixing.mix(docs.drop("key"), ["doc_id", "source"]).collect()
    assert len(got) == 601 and all(0 <= r.taken <= 3 * r.size for r in got)
    sums = collections.defaultdict(int)
    for r in got:
        sums[r.source] += r.taken
    for r in got:
        assert abs(sums[r.source] - r.target) <= 0.02 * r.target + 5
    again = mixing.mix(docs.drop("key").repartition(7), ["doc_id", "source"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(docs.limit(0).drop("key"), ["doc_id"]).collect() == []


def test_shard_quotas_add_up(spark):
    due = spark.createDataFrame([("va", "a", 10.2), ("vb", "b", 29.8), ("n", None, 0.0)], "key string, source string, due double")
    quotas = mixing.shard_quotas(due, 10).collect()
    assert sorted((r.shard, r.source, r.blocks) for r in quotas)[0] == (0, "a", 3)
    totals = collections.Counter()
    for r in quotas:
        totals[r.source] += r.blocks
    assert totals == {"a": 10, "b": 30}


# --- pipeline -------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "test")
        kept[name] = docs
        if name != "bpe":
            assert docs.columns == columns
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("toxic = 1").collect()}
    left = {r.doc_id for r in kept["toxicity"].collect()}
    assert len(toxic & left) <= 0.25 * len(toxic)
    assert kept["near_dedup"].count() == kept["secrets"].count() > 0
    texts = {r.text for r in kept["secrets"].collect()}
    assert {r.text for r in kept["mixing"].collect()} <= texts
    assert all(r.n_tokens == len(r.ids) for r in kept["bpe"].collect())
