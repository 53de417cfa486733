"""Merkle manifest, filter interactions and the attention classifier against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations
from zlib import crc32

import numpy as np
import pytest
from llm_support import SCHEMA, SF, edge, edge_rows, empty, row  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from logpulse.llm import attention_mil, filter_audit, merkle


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---- Merkle manifest -------------------------------------------------------

def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, more=0):
    n = None if r["n_chars"] is None else r["n_chars"] + more
    return sha("".join(map(field, (r["doc_id"], r["source"], r["lang"], n, r["text"]))))


def climb(nodes):
    """Nodes -> (top, the steps of each node: what stands left and right of it)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p // 2 * 2:p // 2 * 2 + 2]
            paths[i].append(("".join(run[:p % 2]), "".join(run[p % 2 + 1:])))
        level = [sha("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
        at = [p // 2 for p in at]
    return level[0], paths


def brute_manifest(rows):
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r["lang"]].append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        ordered = sorted(by_lang[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[g] = ordered, climb([leaf_of(r) for r in ordered])
    root, above = climb([trees[g][1][0] for g in langs])
    out = []
    for g, up in zip(langs, above, strict=True):
        ordered, (subroot, paths) = trees[g]
        for r, p in zip(ordered, paths, strict=True):
            path = p + up
            hit = r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 7 == 0
            fold = leaf_of(r, 1) if hit else leaf_of(r)
            for left, right in path:
                fold = sha(left + fold + right)
            out.append((r["doc_id"], leaf_of(r), subroot, root, sha("".join(a + b for a, b in path)), fold, fold == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest_rows(docs):
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    m = merkle.manifest(docs).select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"),
                                     merkle.folded(F.coalesce("shown", "leaf")).alias("folded_root"))
    return sorted((tuple(r) for r in m.withColumn("verified", F.col("folded_root") == F.col("root")).select(COLUMNS).collect()), key=str)


@pytest.mark.parametrize("levels", [2, 10])
def test_manifest_equals_brute_force(spark, edge, empty, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)  # blocks of 4 leaves take several rounds
    rows = [r.asDict() for r in edge.collect()]
    assert manifest_rows(edge) == brute_manifest(rows)
    assert merkle.manifest(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 8, 33])
def test_manifest_of_every_length(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    docs = spark.createDataFrame([row(i * 3 % n if i % 5 else None, f"text {i}", f"l{i % 3}" if i % 7 else None, "s")
                                  for i in range(n)], SCHEMA).repartition(4)
    got = manifest_rows(docs)
    assert got == brute_manifest([r.asDict() for r in docs.collect()])
    spoilt = {r[0] for r in got if not r[-1]}
    assert spoilt == {r[0] for r in got if r[0] is not None and crc32(str(r[0]).encode()) % 7 == 0}


def test_tampering_leaves_null_lengths_alone_and_never_overflows(spark):
    ids = [i for i in range(100) if crc32(str(i).encode()) % 7 == 0][:2]
    rows = [r[:4] + (n,) + r[5:] for r, n in zip([row(i, "abc") for i in ids], [None, 2**63 - 1], strict=True)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = manifest_rows(docs)
    assert got == brute_manifest([r.asDict() for r in docs.collect()])
    assert [r[-1] for r in sorted(got)] == [True, False]


def test_equal_rows_are_leaves_each(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 3)
    docs = spark.createDataFrame([row(7, "same")] * 40 + [row(i, "x") for i in range(20)], SCHEMA).repartition(5)
    assert manifest_rows(docs) == brute_manifest([r.asDict() for r in docs.collect()])


# ---- Filter interactions ---------------------------------------------------

def brute_fails(rows):
    least = {}
    for r in rows:
        if r["doc_id"] is not None:
            t = r["text"] or ""
            least[t] = min(least.get(t, r["doc_id"]), r["doc_id"])
    out = []
    for r in rows:
        t = r["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        f |= {"A"} if len(words) < 200 else set()
        f |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        f |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        f |= {"E"} if t in least and (r["doc_id"] is None or least[t] < r["doc_id"]) else set()
        out.append((r["source"] or "", f, r["doc_id"]))
    return out


def brute_interactions(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out, shapley = [], Counter()
    fails = brute_fails(rows)
    for order in permutations("ABCDE"):
        for part, f, _ in fails:
            if hit := [x for x in order if x in f][:1]:
                shapley[part, hit[0]] += 1
    for part in {p for p, _, _ in fails}:
        own = [(f, d) for p, f, d in fails if p == part]
        for order in permutations("ABCDE"):
            for i, x in enumerate(order):
                earlier = set(order[:i])
                gone = [(f, d) for f, d in own if x in f and not f & earlier]
                out.append((part, "".join(order), i + 1, sum(not f & (earlier | {x}) for f, _ in own), len(gone),
                            sum(x in f and bool(f & earlier) for f, _ in own), sum(f == {x} for f, _ in own),
                            sum(d in good for _, d in gone), sum(d in toxic for _, d in gone), shapley[part, x]))
    return sorted(out)


def audit_rows(n=160):
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdefgh", k=4)) for _ in range(600)]
    texts = [None, "", " ", "AB|", "X " * 300, "# one", "Word " * 199 + "#"]
    texts += [" ".join(rnd.choices(words, k=k)) + rnd.choice(["", " #", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3]) for k in (10, 199, 200, 260, 400) * 3]
    return [row(rnd.choice([None, *range(90)]), rnd.choice(texts), "en", rnd.choice([None, "", "a", "b"])) for _ in range(n)]


LABELS = [(i % 97, (i * 7) % 3 % 2, i % 5 == 0) for i in range(120)] + [(None, 1, True), (3, None, None)]


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(d, q, None if t is None else int(t)) for d, q, t in LABELS], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("poor_hash", [False, True])
def test_interactions_equal_brute_force(spark, labels, poor_hash):
    docs = spark.createDataFrame(audit_rows(), SCHEMA).repartition(4)
    # of texts that share a hash only equal ones are copies
    how = {"hash_of": lambda t: F.length(t).cast("long")} if poor_hash else {}
    got = sorted(tuple(r) for r in filter_audit.interactions(filter_audit.mask_counts(docs, labels, **how)).collect())
    assert got == brute_interactions([r.asDict() for r in docs.collect()], LABELS)
    assert len(got) == 600 * len({r[0] for r in got})


def test_interactions_of_edge_rows(edge, empty, labels):
    got = sorted(tuple(r) for r in filter_audit.interactions(filter_audit.mask_counts(edge, labels)).collect())
    assert got == brute_interactions([r.asDict() for r in edge.collect()], LABELS)
    assert filter_audit.interactions(filter_audit.mask_counts(empty, labels)).count() == 0
    assert filter_audit.mask_counts(edge, labels.limit(0)).agg(F.sum("good")).first()[0] == 0


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_copies_with_and_without_broadcast(spark, broadcast):
    rows = [(1, "a"), (2, "a"), (None, "a"), (None, "b"), (None, "b"), (5, "c"), (5, "c"), (6, "d")]
    texts = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.xxhash64("text"))
    got = filter_audit.copies(texts, texts.drop("text"), broadcast).join(texts.select("h", "text").distinct(), "h")
    found = sorted((str(r.doc_id), r.text, r["copy"]) for r in got.collect())
    assert found == sorted([("1", "a", False), ("2", "a", True), ("None", "a", True), ("None", "b", False),
                            ("None", "b", False), ("5", "c", False), ("5", "c", False), ("6", "d", False)])


def test_sketch_clears_unique_texts_and_no_repeat(spark):
    n = 20_000
    hashes = spark.range(n).select(F.xxhash64(F.col("id") % (n - 500)).alias("h"))
    suspects = {r.h for r in filter_audit.possible_repeats(hashes, n).collect()}
    count = Counter(r.h for r in hashes.collect())
    assert {h for h, c in count.items() if c > 1} <= suspects
    assert len(suspects) < 500 + 0.01 * n


# ---- Attention classifier --------------------------------------------------

def brute_features(text):
    """Word counts, lengths and shares of the passages of a text of one piece."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", text)
    out = []
    for i in range(0, max(1, len(words)), attention_mil.PASSAGE_WORDS):
        w = words[i:i + attention_mil.PASSAGE_WORDS]
        length = [len(x) for x in w] or [0]
        c, n = Counter(w), len(w) + attention_mil.PRIOR_WORDS
        out.append([np.log1p(len(w)), np.log1p(np.mean(length)), np.log1p(np.std(length)), (len(w) - len(c)) / n,
                    max(c.values(), default=0) / n, sum(a == b for a, b in zip(w, w[1:], strict=False)) / n])
    return np.array(out)


def test_encoding_equals_brute_force():
    texts = [(r[1] or "").encode() for r in edge_rows()] + [b"", b"x", b" \n", b"a  b\x0bc" * 50]
    x, owner = attention_mil.encode(texts)
    for i, t in enumerate(texts):
        own = x[owner == i]
        want = brute_features(t)
        assert own.shape[0] == want.shape[0]
        k = attention_mil.CLASSES
        assert np.allclose(own[:, k:k + 6], want, atol=1e-4), t[:40]
        alone, _ = attention_mil.encode([t])
        assert np.allclose(alone, own)


def test_pieces_hold_the_whole_text(monkeypatch):
    monkeypatch.setattr(attention_mil, "PIECE_BYTES", 50)
    for t in (b"", b"word " * 100, b"x" * 333, b"a" * 49 + b" " + b"b" * 60):
        cut = attention_mil.pieces(t)
        assert b"".join(cut) == t and max(map(len, cut)) <= 50


def test_gradient_is_that_of_the_loss(monkeypatch):
    """One Adam step of tiny rate moves every weight against the numeric gradient."""
    rng = np.random.default_rng(0)
    x, bag = rng.normal(size=(12, attention_mil.FEATURES)).astype(np.float32), np.array([0, 0, 0, 1, 1, 2, 3, 3, 3, 3, 3, 4])
    label, weight = np.array([1, 0, 1, 1, 0]), np.array([1.0, 2, 1, 1, 3])
    monkeypatch.setattr(attention_mil, "SHRINK", 0.0)
    monkeypatch.setattr(attention_mil, "RATE", 1e-6)
    monkeypatch.setattr(attention_mil, "STEPS", 0)
    start = attention_mil.train(x, bag, label, weight)
    monkeypatch.setattr(attention_mil, "STEPS", 1)
    after = attention_mil.train(x, bag, label, weight)

    def loss(model):
        e = model.encoded(x.astype(float))
        a = model.attention(e)
        z = np.array([(a[bag == b, None] * e[bag == b]).sum(axis=0) / a[bag == b].sum() for b in range(5)])
        p = model.score(z)
        return -(weight * np.where(label == 1, np.log(p), np.log(1 - p))).sum() / weight.sum()

    base = loss(start)
    for k, v in start.weights.items():
        flat = np.arange(v.size) if v.size < 12 else rng.choice(v.size, 12, replace=False)
        for i in flat:
            w = {n: u.copy() for n, u in start.weights.items()}
            w[k].flat[i] += 1e-5
            slope = (loss(attention_mil.Model(start.mean, start.scale, w)) - base) / 1e-5
            moved = after.weights[k].flat[i] - v.flat[i]
            if abs(slope) > 1e-4:
                assert np.sign(moved) == -np.sign(slope), (k, i)


def test_one_bad_passage_tells_the_document(spark):
    """Labels are the documents', yet the passage that decides gets the weight."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("etaoinshr", k=rnd.randint(2, 8)))
    rows, marks = [], []
    for i in range(400):
        passages = [" ".join(word() for _ in range(64)) for _ in range(rnd.randint(2, 6))]
        bad = i % 2 == 0
        if bad:
            at = rnd.randrange(len(passages))
            passages[at] = " ".join(word() + "***" for _ in range(64))
            marks.append((i, at))
        rows.append(row(i, " ".join(passages)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(400)], "doc_id long, quality int")
    got = {r.doc_id: r for r in attention_mil.scores(docs, attention_mil.fit(docs, labels)).collect()}
    held = [i for i in range(400) if crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(got[i].score >= 0.5) == (i % 2 == 1) for i in held]) > 0.95
    assert np.mean([got[i].attended == at for i, at in marks]) > 0.8


def test_held_out_accuracy_and_contract(spark):
    got = entry_mod.queries()["op12_gated_attention"](spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    for r in got:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    pos, neg = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.97
    assert np.mean([s >= 0.5 for s in pos]) > 0.97


def test_scores_of_edge_rows(spark, edge, empty, monkeypatch):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    model = attention_mil.fit(edge, labels)
    whole = sorted(tuple(r) for r in attention_mil.scores(edge.where("doc_id is not null"), model).collect())
    assert len(whole) == edge.where("doc_id is not null").count() and all(0 <= r[1] <= 1 for r in whole)
    assert len({r[1] for r in whole if r[0] in (20, 21, 22)}) == 1  # null, empty and blank alike
    assert attention_mil.scores(empty, model).count() == 0
    assert attention_mil.fit(edge, labels.limit(0)) == 0.5
    assert attention_mil.fit(edge, labels.where("quality = 1")) > 0.5
    assert {r.score for r in attention_mil.scores(edge, 0.5).collect()} == {0.5}
