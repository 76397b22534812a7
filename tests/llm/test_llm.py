"""Operators of the llm subpackage against brute force, round trips and held-out rows."""

import base64
import hashlib
import tracemalloc
from io import BytesIO

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from sliceforge.llm import ann, bpe, media, neardup, packing, preference, quality, secrets, simhash, substring, toxicity
from sliceforge.runtime import ARROW_BYTES

DDL = "doc_id long, text string, lang string, source string, n_chars long, spans string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1, "clash") for i, t in texts], DDL)


CASES = [
    (1, " ".join(f"w{i}" for i in range(60))),
    (2, "head " + " ".join(f"w{i}" for i in range(10, 45)) + " tail"),
    (3, None),
    (4, ""),
    (5, "same " * 70),
    (6, "a b " * 30),
    (7, " ".join(f"w{i}" for i in range(60))),
    (None, " ".join(f"w{i}" for i in range(60))),
    (8, "x" * 30000),
]


def brute_repeats(texts, window=20):
    first, out = {}, {}
    for i, t in sorted((i, t) for i, t in texts if i is not None):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            if k in first:
                gone[s : s + window] = [True] * window
            else:
                first[k] = i
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def test_repeats_match_brute_force(spark):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(docs(spark, CASES)).collect() if r.doc_id is not None}
    assert got == brute_repeats(CASES)
    kept = substring.strip_stage(docs(spark, CASES))
    assert kept.columns == docs(spark, CASES).columns and kept.count() == len(CASES)
    assert substring.remove_repeats(docs(spark, CASES).limit(0)).count() == 0


def test_repeats_hold_little_in_memory():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(20000)]
    texts = [" ".join(rng.choice(vocabulary, 350)) for _ in range(500)] * 2
    held = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts})
    whole = substring.Batch([t.encode() for t in texts], 20)
    anchors = np.unique(np.concatenate([p.key for p in whole.places]))
    merged = [b.places for _, b in substring.parts([t.encode() for t in texts], 20)]
    assert len(merged) > 1 and np.array_equal(np.unique(np.concatenate([p.key for places in merged for p in places])), anchors)
    n = len(whole.starts)
    del whole, merged
    packed = pa.RecordBatch.from_pydict({"batch": [1, 2], "payload": [substring._sealed(held)] * 2, "anchors": [anchors.view(np.int64)] * 2})
    tracemalloc.start()
    try:
        # second copies are known at once, first ones go on in chunks
        places = [column for b in substring._windows(iter([packed]), 20) for column in b.column(3).to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(p & 0xFFFFFFFF for p in places) == 2 * n
    assert peak < 100e6


def test_batches_for_python_are_small(spark):
    rows = docs(spark, [(i, f"{i} " + "x" * 40000) for i in range(600)]).coalesce(1)
    packed = substring.packs(rows)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    most = max(r.n for r in rows.select("text").mapInArrow(sizes, "n long").collect())
    assert most <= 2 * ARROW_BYTES
    # packs are filled across those batches
    texts = [len(pa.ipc.open_stream(r.payload).read_next_batch()) for r in packed.collect()]
    assert sum(texts) == 600 and sorted(texts)[1] >= substring.BATCH_BYTES // 40010


def test_repeats_tell_long_words_apart(spark):
    a = "".join("ab"[bin(i).count("1") & 1] for i in range(4096))
    b = a.translate(str.maketrans("ab", "ba"))
    for n in (64, 512, 1024, 2048, 4096):
        rest = " ".join(f"w{i}" for i in range(19))
        texts = [(1, f"{a[:n]} {rest}"), (2, f"{b[:n]} {rest}")]
        assert [r.n_removed for r in substring.remove_repeats(docs(spark, texts)).collect()] == [0, 0]
    # the same pattern of two words
    flip = [(1, a[:2048].replace("a", "x ").replace("b", "y ")), (2, b[:2048].replace("a", "x ").replace("b", "y "))]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(docs(spark, flip)).collect()}
    assert got == brute_repeats(flip)


def test_simhash_links(spark):
    fps = [0, 1, 3, 7, 1 << 40, (1 << 40) | 1, -1, 12345678901234, 12345678901235]
    rng = np.random.default_rng(1)
    base = int(rng.integers(1 << 62))
    fps += [base ^ (1 << int(a)) for a in rng.permutation(64)[:12] if a < 63]  # a crowd around one value
    e = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in e:
        assert (int(r.u) ^ int(r.v)) & ((1 << 64) - 1) and bin((r.u ^ r.v) & ((1 << 64) - 1)).count("1") <= 2
        parent[root(r.u)] = root(r.v)
    for a in fps:
        for b in fps:
            if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2:
                assert root(a) == root(b)


def test_simhash_documents(spark):
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(docs(spark, CASES)).collect()}
    assert got[7][1] == 1 and got[3] == (0, 3) and got[4][1] == 3
    one = simhash.fingerprint("One two")
    assert one == int(np.uint64(xxhash.xxh64_intdigest(b"one two", seed=42)).astype(np.int64))
    assert simhash.keep_one(docs(spark, CASES)).filter("doc_id = 7").count() == 0


def brute_kept(texts, shingle=5):
    """Smallest ids of the components of all pairs with Jaccard similarity 0.8 or more."""
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[s : s + shingle]) for s in range(max(1, len(w) - shingle + 1))}
    low = {i: i for i in sets}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if 4 * max(len(a), len(b)) <= 5 * min(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((root(i), root(j)))
                low[y] = x
    return {i for i in ids if root(i) == i}


def test_near_copies_match_brute_force(spark):
    rng = np.random.default_rng(9)
    texts = [(i, t) for i, t in CASES if i is not None]
    for base in range(40):
        words = [f"v{x}" for x in rng.integers(0, 500, int(rng.integers(1, 200)))]
        for copy in range(6):
            w = list(words)
            for at in rng.integers(0, len(w), int(rng.integers(0, max(2, len(w) // 25)))):
                w[at] = f"u{rng.integers(0, 500)}"
            texts.append((100 + base * 10 + copy, (" " if copy % 2 else "\t").join(w).title()))
    want = brute_kept(texts)
    frame = docs(spark, [*texts, (None, "no id"), (100, texts[-1][1])]).repartition(5)
    got = [r.doc_id for r in simhash.keep_one(docs(spark, texts)).collect()]
    assert sorted(got) == sorted(want) and len(want) < len(texts) - 50
    assert [r.text for r in simhash.keep_one(frame).filter("doc_id IS NULL").collect()] == ["no id"]
    assert simhash.keep_one(frame.limit(0)).count() == 0


def test_near_copies_of_a_hub_and_of_loose_families(spark):
    """Variants that are like their base but not like each other, chains, and families just below the limit."""
    rng = np.random.default_rng(21)
    texts = []

    def add(words):
        texts.append((len(texts), " ".join(words)))

    def changed(words, spots):
        w = list(words)
        for at in spots:
            w[at] = f"x{rng.integers(0, 1 << 40)}"
        return w

    for family, (size, step) in enumerate(((40, 9), (30, 13), (25, 11))):
        base = [f"f{family}w{i}" for i in range(400)]
        for _ in range(size):
            add(changed(base, rng.choice(400, step, replace=False)))
        add(base)
    chain = [f"c{i}" for i in range(300)]
    for _ in range(12):
        chain = changed(chain, rng.choice(300, 5, replace=False))
        add(chain)
    got = sorted(r.doc_id for r in simhash.keep_one(docs(spark, texts)).collect())
    want = sorted(brute_kept(texts))
    assert got == want and 10 < len(want) < len(texts) - 20


def test_fingerprints_propose_near_copies(spark, monkeypatch):
    """Without MinHash keys the stage finds what fingerprints show, and an exact comparison still decides."""
    rng = np.random.default_rng(33)
    texts = [(1, None), (2, ""), (3, " \t"), (4, "one two"), (5, "One\ttwo")]
    for base in range(12):
        words = [f"b{base}w{i}" for i in range(2000)]
        texts.append((100 + base * 10, " ".join(words)))
        for copy in (1, 2):
            w = list(words)
            w[int(rng.integers(2000))] = f"x{rng.integers(1 << 40)}"
            texts.append((100 + base * 10 + copy, " ".join(w)))
    # fingerprints count repeats, similarity does not: these are one bit apart or none, and differ
    texts += [(900 + k, "a b c " * 3000 + " ".join(f"k{k}i{i}" for i in range(8))) for k in range(2)]
    fps = {i: simhash.fingerprint(t) for i, t in texts}
    far = {(i, j): bin((fps[i] ^ fps[j]) & ((1 << 64) - 1)).count("1") for i in fps for j in fps if i < j}
    close = {pair for pair, n in far.items() if n <= 2}
    assert (900, 901) in close and sum(i >= 100 for i, _ in close) > 8
    whole = brute_kept(texts)
    assert {900, 901} <= whole and sorted(r.doc_id for r in simhash.keep_one(docs(spark, texts)).collect()) == sorted(whole)
    frame = docs(spark, texts).selectExpr("doc_id AS tid", "text")
    got = {tuple(sorted((r.u, r.v))) for r in simhash.proposals(frame).collect()}
    assert all(far[p] <= simhash.REACH for p in got) and any(far[p] > 2 for p in got)
    monkeypatch.setattr(neardup, "key_links", lambda t: t.select(F.col("tid").alias("u"), F.col("tid").alias("v")).limit(0))
    kept = {r.doc_id for r in simhash.keep_one(docs(spark, texts)).collect()}
    assert whole <= kept and {j for i, j in close} - {901} <= set(fps) - kept


def test_near_copies_in_blocks(monkeypatch):
    texts = [b"", b"one", *(" ".join(f"w{i * j}" for i in range(40 * j)).encode() for j in range(1, 9))]
    whole = neardup.band_keys(*neardup.shingles(texts))
    monkeypatch.setattr(neardup, "_BLOCK", 7)
    assert (neardup.band_keys(*neardup.shingles(texts)) == whole).all()


def test_bpe_matches_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", " ", "a  b\n\n c", "it's  ünï 123\t", "x" * 5000, "end ", "日本 語", "<|endoftext|>", "a b"]
    assert bpe.encode_ids(texts, path) == [lib.encode_ordinary(t) for t in texts]
    enc = bpe.encode(docs(spark, list(enumerate(texts))), path)
    assert {r.doc_id: bytes(r.bytes).decode() for r in bpe.decode(enc, path).collect()} == dict(enumerate(texts))


def test_packing_covers_every_id(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack(docs(spark, CASES), path, 64).collect()
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_seq.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at == 64 or at & (at - 1) == 0
    one = sorted((r.start, r.length) for r in got if r.doc_id == 8)
    assert sum(n for _, n in one) == next(r.doc_tokens for r in got if r.doc_id == 8)
    assert [(r.length, r.doc_tokens) for r in got if r.doc_id == 3] == [(1, 1)]


def test_secrets(spark):
    text = 'api_key = "abcdef123" AKIA' + "A1" * 10 + " " + "0af9" * 8 + " password: x"
    found = secrets.base_spans(text)
    assert [k for k, _, _ in found] == ["assign", "access", "hex"]
    items, labels, kinds = secrets.labelled_findings(600, seed=5)
    net = secrets.train(items, labels, kinds, epochs=4)
    fresh, truth, _ = secrets.labelled_findings(300, seed=99)
    assert ((net.score(fresh) >= 0.5) == (truth == 1)).mean() > 0.9
    assert len(set(net.cuts.values())) == len(secrets.KINDS)
    out = {r.doc_id: r.spans for r in secrets.scan(docs(spark, [(1, text), (2, None), (3, "")]), net).collect()}
    assert len(out[1]) >= 3 and out[2] == [] and out[3] == []


def test_stages_keep_other_columns(spark):
    big = 2**60 + 1  # no double holds it
    rows = [(big, "plain words", None, "s", None, "clash"), (None, None, "en", None, 1, None), (3, "password=abcdef123 end", "en", "s", big, "x")]
    frame = spark.createDataFrame(rows, DDL)
    out = secrets.redact_stage(frame)
    assert out.columns == frame.columns
    want = [rows[0], rows[1], (3, "<assign> end", "en", "s", big, "x")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, substring.strip_stage(frame).collect()), key=str) == sorted(rows, key=str)
    labels = spark.createDataFrame([(3, 0)], "doc_id long, toxic int")
    assert sorted(map(tuple, toxicity.drop_toxic(frame, labels).collect()), key=str) == sorted(rows, key=str)
    assert secrets.redact_stage(frame.limit(0)).count() == toxicity.drop_toxic(frame.limit(0), labels).count() == 0


def test_toxicity_learns():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(400)]
    texts, labels = [], []
    for i in range(400):
        body = list(rng.choice(words, 40))
        if i % 4 == 0:
            body[int(rng.integers(40))] = "vilestem" + str(rng.integers(50))
        texts.append(" ".join(body).encode())
        labels.append(int(i % 4 == 0))
    m = toxicity.train(texts[:300], np.array(labels[:300]))
    s, _ = toxicity.score_texts(m, [*texts[300:], b""])
    assert ((s[:-1] >= 0.5) == np.array(labels[300:])).mean() > 0.95 and 0 <= s[-1] < 0.5


def test_toxicity_passes_over_long_texts(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 4000)
    monkeypatch.setattr(toxicity, "train", lambda texts, marks: seen.update(rows=sorted(zip(texts, marks.tolist(), strict=True))))
    short = [(i, f"text {i}") for i in range(100)]
    long = [(i, "long " * (900 if i % 2 else 300)) for i in range(100, 200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    toxicity.fit(docs(spark, [*short, *long]), labels)
    free = {r.doc_id for r in labels.filter(~toxicity.held_out()).collect()}
    # every short text is fitted on, and long ones only as far as the bytes go
    assert {(t.encode(), int(i % 4 == 0)) for i, t in short if i in free} <= set(seen["rows"])
    assert sum(len(t) for t, _ in seen["rows"]) <= 4000
    # a label whose texts are all too long still has one
    toxicity.fit(docs(spark, [(i, t if i % 4 else "long " * 900) for i, t in short]), labels)
    assert sum(y for _, y in seen["rows"]) == 1
    # labels without a document use up nothing of the sample
    orphans = labels.unionByName(spark.range(1000, 9000).selectExpr("id AS doc_id", "0 AS toxic"))
    toxicity.fit(docs(spark, short), orphans, max_docs=100)
    assert len(seen["rows"]) == len([i for i, _ in short if i in free])


def test_toxicity_shares_the_bytes():
    assert toxicity.fitting({0: {1: 1, 2: 2, 3: 3}, 1: {4: 4}}, 100) == {1, 2, 3, 4}
    assert toxicity.fitting({0: {1: 10, 2: 10, 3: 10, 4: 20}, 1: {5: 45}}, 80) == {1, 2, 3, 5}
    assert toxicity.fitting({0: {1: 1, 2: 2, 3: 90}, 1: {4: 3, 5: 30}}, 50) == {1, 2, 4, 5}
    assert toxicity.fitting({0: {1: 500}, 1: {2: 3}}, 50) == {1, 2}
    assert toxicity.fitting({}, 50) == set()


def test_ann_exact_on_small(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 8)).astype(np.float32)
    data = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [])]
    got = ann.search(spark.createDataFrame(data, "vec_id long, embedding array<float>"), F.col("id") % 40 == 0, k=5).collect()
    for q in (0, 40, 80):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == list(np.argsort(d, kind="stable")[:5])


def recall(x, q, got, k=10):
    d = ((x - x[q]) ** 2).sum(1)
    d[q] = np.inf
    return len(set(np.argsort(d, kind="stable")[:k].tolist()) & set(got)) / k


def test_ann_recall(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 24)).astype(np.float32).astype(float)
    frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)

    def mean_recall(rerank):
        found = {}
        for r in ann.search(frame, F.col("id") % 100 == 0, rerank=rerank).collect():
            found.setdefault(r.query_id, []).append(r.vec_id)
        return np.mean([recall(x, q, g) for q, g in found.items()])

    monkeypatch.setattr(ann, "CHUNK", 300)
    monkeypatch.setattr(ann, "CHUNKS_A_TASK", 3)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    assert mean_recall(40) > 0.9
    good = ann.encode
    monkeypatch.setattr(ann, "encode", lambda b, v: tuple(part[rng.permutation(len(v))] for part in good(b, v)))
    assert mean_recall(40) < 0.2  # codes of other vectors find nothing


@pytest.mark.parametrize("shape", ["wide", "shifted", "uneven"])
def test_ann_rows_that_codes_fit_badly(spark, monkeypatch, shape):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2500, 96))
    if shape == "shifted":  # all far from zero and close together
        x = 1000 + 0.001 * x
    if shape == "uneven":  # lengths over ten orders of magnitude, and copies
        x = x * np.exp(rng.normal(0, 4, (2500, 1)))
        x[1000:1040] = x[1000]
    x = x.astype(np.float32).astype(float)
    monkeypatch.setattr(ann, "TRAIN_VECTORS", 300)
    monkeypatch.setattr(ann, "CHUNK_BYTES", 50_000)
    monkeypatch.setattr(ann, "CHUNKS_A_TASK", 3)
    frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    found = {}
    for r in ann.search(frame, F.col("id") % 100 == 0, rerank=20).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert len(found) == 25
    for q, got in found.items():
        d = np.zeros(len(x))
        for c in range(96):
            d += (x[:, c] - x[q, c]) ** 2
        d[q] = np.inf
        best = np.argsort(d, kind="stable")[:10]
        assert sorted(got) == [(n, i, float(np.sqrt(d[i]))) for n, i in enumerate(best.tolist(), 1)]


def test_ann_odd_rows(spark):
    big = 2**60 + 4
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (3, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0]), (5, [1.0, None]), (7, [float("inf"), 1.0]), (9, [1e30, 1.0]), (big, [0.5, 0.5]), (11, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, row string, score string")
    got = ann.search(frame, F.col("id") % 4 == 0, k=3).collect()
    first = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == 0)
    # both rows of id 0 ask, each finds the other; ties go to the smaller id
    assert first == [(1, 0, 0.0)] * 2 + [(2, 2, 0.0)] * 2 + [(3, 3, 0.0)] * 2
    assert {r.query_id for r in got} == {0, big} and all(r.vec_id not in (5, 7, 11) for r in got)
    assert ann.search(frame.limit(0), F.col("id") % 4 == 0).count() == 0


@pytest.mark.parametrize("shape", [(5, 7), (4, 6, 3)])
def test_media_round_trip(shape):
    image = np.random.default_rng(2).integers(0, 256, shape).astype(np.uint8)
    assert (media.decode(media.encode_netpbm(image)) == image).all()
    if image.ndim == 3:
        assert (media.decode(media.encode_bmp(image)) == image).all()
    same = media.resize(image, *shape[:2])
    assert np.allclose(same, image) and np.isclose(media.resize(image, 2, 3).mean(), image.mean())


def test_media_texts(spark):
    got = {r.doc_id: r for r in media.measure(media.store_texts(docs(spark, CASES))).collect()}
    assert got[3].n_bytes == 0 and got[3].payload_bytes == 64
    padded = ("x" * 30000).encode() + b"\0" * 16
    assert got[8].payload_sha256 == hashlib.sha256(padded).hexdigest()
    tall = np.arange(5000 * 64, dtype=np.int64).astype(np.uint8).reshape(-1, 64)
    assert (media.read_back(media.stored(tall)) == tall).all() and media.stored(tall).count(b"NUMPY") == 5


def test_images(spark):
    image = np.random.default_rng(3).integers(0, 256, (40, 60, 3)).astype(np.uint8)
    bmp, pgm = media.encode_bmp(image), media.encode_netpbm(image[:, :, 0])
    big = 2**60 + 1
    frame = spark.createDataFrame([(big, bytearray(bmp), 1), (None, bytearray(pgm), 2), (3, None, 3), (4, bytearray(b""), 4), (5, bytearray(b"P5\n9 9\n255\nxx"), 5), (big, bytearray(bmp), 6)], "id long, data binary, npy long")
    out = media.images(frame, "id", "data", 20, 30, 16).collect()
    mine = [r for r in out if r.id == big]
    assert len(mine) == 2 * 2 * 2 and {r.error for r in mine} == {None}
    parts = {(r.tile_row, r.tile_col): np.load(BytesIO(bytes(r.npy))) for r in mine}
    whole = np.concatenate([np.concatenate([parts[y, x] for x in (0, 1)], axis=1) for y in (0, 1)])
    assert (whole == np.rint(image.reshape(20, 2, 30, 2, 3).mean(axis=(1, 3))).astype(np.uint8)).mean() > 0.99
    assert sorted(str(r.id) for r in out if r.error) == ["3", "4", "5"] and len([r for r in out if r.id is None]) == 4
    assert media.images(frame.limit(0), "id", "data", 2, 2).count() == 0


def test_preference(spark):
    talk = [(1, 0, "user", "q"), (1, 1, "assistant", "good"), (2, 0, "user", "q"), (2, 1, "assistant", "bad"), (3, 0, "user", "q"), (3, None, "user", "z"), (None, 0, "user", "z")]
    conv = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    out = preference.format_pairs(conv, spark.createDataFrame([(1, 2), (3, 1), (1, 9)], "chosen_id long, rejected_id long")).orderBy("chosen_id").collect()
    assert [(r.chosen_id, r.prompt_turns) for r in out] == [(1, 1), (3, 1)]
    assert out[0].prompt == "<|user|>\nq\n<|end|>\n" and "good" in out[0].chosen and "bad" in out[0].rejected and out[1].chosen == ""
    assert preference.pairs_by_prompt(conv).count() == 2
    odd = [(-2, 0, "user", "q"), (-1, 0, "user", None), (2, 0, "user", "q"), (2, 0, "user", "q"), (2, 1, "assistant", "A"), (2, 2, "user", "more"), (3, 1, "assistant", "B"), (3, 0, "user", "q"), (4, 0, "assistant", "alone"), (None, 0, "user", "z")]
    made = {r.chosen_id: r for r in preference.format_turns(preference.swapped(spark.createDataFrame(odd, conv.schema))).collect()}
    assert sorted(made) == [-2, -1, 2, 3, 4]
    assert (made[2].rejected_id, made[2].prompt_turns) == (3, 1) and "B" in made[2].rejected and "more" in made[2].rejected and "A" in made[2].chosen
    assert (made[3].rejected_id, made[3].prompt_turns) == (2, 1) and made[3].rejected == "<|assistant|>\nA\n<|end|>\n"
    assert made[4].rejected_id is None and made[4].rejected == "" and made[4].distinct
    assert made[-2].rejected_id == -2 and not made[-2].distinct and made[-2].prompt_turns == 1
    assert preference.swapped(conv.limit(0)).count() == 0


def brute_kneser_ney(trusted, order):
    """Probability function of an interpolated modified Kneser-Ney model over folded bytes, by dictionaries."""
    fold = [bytes(quality._FOLD[list(t)].astype(np.uint8)) if t else b"" for t in trusted]
    tables = {order: {}}
    for t in fold:
        t = b" " * (order - 1) + t
        for i in range(len(t) - order + 1):
            g = t[i : i + order]
            tables[order][g] = tables[order].get(g, 0) + 1
    for k in range(order - 1, 0, -1):
        tables[k] = {}
        for g in tables[k + 1]:
            tables[k][g[1:]] = tables[k].get(g[1:], 0) + 1
    cuts, totals, spared = {}, {}, {}
    for k, grams in tables.items():
        n = [max(1, sum(v == i for v in grams.values())) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [i + 1 - (i + 2) * y * n[i + 1] / n[i] for i in range(3)]
        cuts[k] = [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]
        for g, v in grams.items():
            c = g[:-1]
            totals[c] = totals.get(c, 0) + v
            spared[c] = spared.get(c, 0) + cuts[k][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / quality.SYMBOLS
        v, c = tables[len(g)].get(g, 0), g[:-1]
        if c not in totals:
            return p(g[1:])
        own = (v - cuts[len(g)][min(v, 3) - 1]) / totals[c] if v else 0
        return own + spared[c] / totals[c] * p(g[1:])

    return p


def test_quality_matches_brute_force(spark):
    base = [b"The cat sat on the mat and the dog ran 12 times", b"a dog\tran on the mat", b"", b"the end of the cat and of the dog"]
    asked = [*base, b"zq#x!!zz", "ünï the dog".encode(), b"x"]
    texts = docs(spark, [(i, t.decode()) for i, t in enumerate(asked)] + [(None, None), (0, asked[0].decode())])
    labels = spark.createDataFrame([(i, 1) for i in range(len(base))] + [(4, 0), (None, 1)], "doc_id long, quality int")
    got = quality.classify(texts, labels).collect()
    assert len(got) == len(asked) + 2
    counted = {r.doc_id for r in labels.filter("quality = 1").filter(quality._counted()).collect()}
    assert 0 < len(counted & {0, 1, 2, 3}) <= 4
    p = brute_kneser_ney([t for i, t in [*enumerate(base), (0, base[0])] if i in counted], quality.ORDER)  # the repeated row is trusted text as well
    for c in (b"the ", b"zzzz", b"n th"):
        assert np.isclose(sum(p(c + bytes([b])) for b in range(256)), 1)
    for r in got:
        t = bytes(quality._FOLD[list(asked[r.doc_id])].astype(np.uint8)) if r.doc_id is not None and asked[r.doc_id] else b""
        t = b" " * (quality.ORDER - 1) + t
        logs = [np.log(max(p(t[i : i + quality.ORDER]), 1e-12)) for i in range(len(t) - quality.ORDER + 1)]
        want = np.exp(-np.mean(logs)) if logs else quality.SYMBOLS
        assert np.isclose(r.perplexity, want, rtol=1e-4), (r, want)
    assert quality.classify(texts.limit(0), labels).count() == 0
    assert all(r.kept == 1 for r in quality.classify(texts, labels.limit(0)).collect())
