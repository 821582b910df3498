"""Quality, toxicity, language and media."""

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridquill.llm import labelled, langid, media, quality, toxicity
from gridquill.llm.queries import QUERIES
from gridquill.llm.textvec import Words, shingle_sets, utf8, windows

from .cases import documents, empty

MEDIUM = "/root/testdata/sf0.01"


def joined(name, column, spark):
    got = QUERIES[name](spark, MEDIUM)
    return got.join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").select("held_out", "score", "predicted", F.col(column).alias("y")).toPandas()


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_quality_on_held_out_rows(spark):
    rows = joined("op4_quality", "quality", spark)
    held = rows[rows.held_out]
    assert len(held) > 40 and auc(held.score.to_numpy(), held.y.to_numpy()) > 0.97 and (held.predicted == held.y).mean() > 0.94
    assert (rows.predicted == (rows.score >= 0.3)).all() and rows.score.between(0, 1).all()


def test_toxicity_on_held_out_rows(spark):
    rows = joined("op7_toxicity", "toxic", spark)
    held = rows[rows.held_out]
    # Better than calling nothing toxic, which is right for most rows.
    assert auc(held.score.to_numpy(), held.y.to_numpy()) > 0.85 and (held.predicted == held.y).mean() > 1 - held.y.mean()
    assert (rows.predicted == (rows.score >= 0.5)).all()


def test_language_on_held_out_rows(spark):
    got = QUERIES["op6_language_id"](spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98 and got.score.between(0, 1).all() and got.rejected.mean() < 0.01


def test_held_out_rows_teach_nothing(spark):
    """Labels of held-out rows turned over change no score."""
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(labelled.held_out(F.col("doc_id"), 5, 0), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = labelled.training_labels(labels, "toxic"), labelled.training_labels(turned, "toxic")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize("make", [documents, empty])
def test_edges(make, spark):
    d = make(spark)
    labels = spark.createDataFrame([(1, 1, 1), (4, 0, 0), (4, 0, 1), (5, None, 0), (9, 0, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    for module, column in ((quality, "quality"), (toxicity, "toxic")):
        for own in (labels, labels.limit(0)):
            model = module.fit(d, labelled.training_labels(own, column, 1, 5))
            rows = module.score(d, model).collect()
            assert len(rows) == d.count() and all(0 <= r.score <= 1 for r in rows)
            assert len({r.score for r in rows if r.doc_id in (1, 6)}) <= 1
    model = langid.fit(d)
    rows = {r.doc_id: r for r in langid.identify(d, model, ("doc_id", "n")).collect()}
    if rows:
        assert all(rows[k].lang_pred == "und" and rows[k].rejected and rows[k].score == 0 for k in (2, 3, 4, 7)) and rows[8].lang_pred != "und"
    else:
        assert langid.identify(documents(spark), model).where("lang_pred <> 'und'").count() == 0


def test_several_centroids_by_language():
    x = np.eye(6, dtype=np.float32)[[0, 0, 1, 1, 2, 2]]
    c = langid.spherical_kmeans(x, 3)
    assert sorted(np.argmax(c, 1).tolist()) == [0, 1, 2]


def test_distance_rejects_other_scripts(spark):
    rows = [(k, w * 30, lang, "s") for k, (w, lang) in enumerate([("the house and the dog ", "en"), ("der Hund und das Haus ", "de")] * 30)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    other = spark.createDataFrame([(1, "съешь ещё этих мягких французских булок " * 5), (2, "the dog and the house " * 5)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(other, model).collect()}
    assert got[1].rejected and not got[2].rejected and got[2].lang_pred == "en"


def test_languages_left_out_of_the_fit_are_rejected(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").where("lang is not null and text is not null").select("doc_id", "text", "lang")
    rng = np.random.default_rng(0)
    noise = ["".join(map(chr, rng.integers(a, b, 2000))) for a, b in ((97, 123), (0x4E00, 0x9FFF))]
    noise = spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string")
    for out in sorted(r.lang for r in docs.select("lang").distinct().collect()):
        model = langid.fit(docs.where(F.col("lang") != out))
        got = langid.identify(docs, model, ("lang",)).toPandas()
        own = got.lang == out
        assert got.rejected[own].mean() >= 0.96 and got.rejected[~own].mean() <= 0.001, out
        assert langid.identify(noise, model).where("rejected").count() == 2


def test_dual_coordinate_descent_separates():
    x = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])]
    y = np.array([1.0, 1.0, -1.0, -1.0])
    ratio = np.array([1.0, -1.0, 0.1, 0.1])
    w, b = quality.dual_coordinate_descent(x, y, ratio, np.full(4, 10.0))
    assert all(np.sign((w * ratio)[c].sum() + b) == t for c, t in zip(x, y, strict=True))


def test_quality_scores_against_a_plain_fit(spark):
    """Counts, ratios, cells and scores made again text by text; the fitted weights are taken as they are."""
    texts = [(k, ("good clean words of sense here " if k % 2 else "BUY now!!! $$$ 99 click ") * (1 + k % 5) + f"t{k % 9}", k % 2) for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, label int")
    labels = docs.select("doc_id", "label")
    model = quality.fit(docs, labels)

    def cells(text):
        data, offsets = utf8(pa.array([text]))
        return np.unique(quality.features(data, offsets) & (1 << quality.CELL_BITS) - 1)

    n = np.ones((2, 1 << quality.CELL_BITS))
    for _, text, label in texts:
        n[label][cells(text)] += 1
    ratio = np.array([np.log(n[1][c] / 32) - np.log(n[0][c] / 32) for c in cells(texts[0][1])])
    assert np.allclose(model.ratio[cells(texts[0][1])], ratio)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    for k, text, _ in texts:
        c = cells(text)
        margin = sum(model.weights[i] for i in c) / np.sqrt(sum(model.ratio[i] ** 2 for i in c)) + model.bias
        assert abs(got[k] - 1 / (1 + np.exp(-(model.slope * margin + model.offset)))) < 1e-6
    assert all((got[k] > 0.5) == bool(label) for k, _, label in texts)
    c, w = cells(texts[0][1]), np.random.default_rng(0).normal(size=1 << quality.CELL_BITS)
    less = n.copy()
    less[0][c] -= 1
    less = np.maximum(less, 1)
    own = np.log(less[1][c] / 32) - np.log(less[0][c] / 31)
    assert abs(quality.left_out_margin(w, 0.5, n, (30, 30), c, 0) - ((w[c] * own).sum() / np.linalg.norm(own) + 0.5)) < 1e-9


def plain_ftrl(x, y, epochs, alpha, beta, l1, l2):
    """One coordinate at a time, weights in a dictionary."""
    z, n = {}, {}

    def weight(i):
        if i == "bias":
            return -z.get(i, 0.0) / ((beta + np.sqrt(n.get(i, 0.0))) / alpha)
        v = z.get(i, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - np.sign(v) * l1) / ((beta + np.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for own, label in zip(x, y, strict=True):
            w = {i: weight(i) for i in [*own.tolist(), "bias"]}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for i, v in w.items():
                old = n.get(i, 0.0)
                n[i] = old + g * g
                z[i] = z.get(i, 0.0) + g - (np.sqrt(n[i]) - np.sqrt(old)) / alpha * v
    return weight


def test_ftrl_against_a_plain_version():
    rng = np.random.default_rng(2)
    y = (rng.random(300) < 0.4).astype(float)
    x = [np.unique(np.append(rng.integers(0, 50, 8), 60 if t else 61)) for t in y]
    w, bias = toxicity.ftrl(x, y, 3, 0.7, 1.0, 0.5, 0.1)
    want = plain_ftrl(x, y, 3, 0.7, 1.0, 0.5, 0.1)
    assert np.allclose([want(i) for i in range(70)], w[:70]) and abs(want("bias") - bias) < 1e-9


def test_toxicity_scores_against_plain_features(spark):
    texts = [(k, ("you idiot go away " if k % 4 == 0 else "thank you for the kind words ") + f"w{k % 7} " * 3, int(k % 4 == 0)) for k in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, label int")
    model = toxicity.fit(docs, docs.select("doc_id", "label"))
    dense = model.dense()

    def cells(text):
        words = [Words(*utf8(pa.array([w]))).hash[0] for w in text.split()]
        pairs = [toxicity.mix(np.array([a], np.uint64) * np.uint64(salt) + np.array([b], np.uint64))[0] for gap, salt in ((1, 0x51ED270B0B0B0B0B), (2, 0x2545F4914F6CDD1D)) for a, b in zip(words, words[gap:], strict=False)]
        return {int(h >> np.uint64(64 - toxicity.CELL_BITS)) for h in [*words, *pairs]}

    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for k, text, label in texts:
        margin = model.bias + sum(dense[c] for c in cells(text))
        assert abs(got[k] - 1 / (1 + np.exp(-(model.slope * margin + model.offset)))) < 1e-6 and (got[k] > 0.5) == bool(label)


def test_language_vectors_against_plain_counts(spark, monkeypatch):
    """Frequencies, vectors and cosines made again from trigrams in a dictionary, over one and several blocks of languages."""
    rng = np.random.default_rng(3)
    alphabets = {f"l{k}": [chr(97 + int(c)) for c in rng.permutation(26)[:8]] for k in range(5)}
    text = lambda letters: " ".join("".join(rng.choice(letters, 4)) for _ in range(30))
    rows = [(k, text(alphabets[f"l{k % 5}"]), f"l{k % 5}") for k in range(200)] + [(900, "12 34 !!", "l0"), (901, None, "l1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)

    def counts(t):
        folded = " " + "".join(c if c.isalpha() else " " for c in t.lower())
        while "  " in folded:
            folded = folded.replace("  ", " ")
        out = {}
        for a, b, c in zip(folded, folded[1:], folded[2:], strict=False):
            cell = int(langid.mix(np.array([ord(a) | ord(b) << 8 | ord(c) << 16], np.uint64))[0] % np.uint64(langid.DIM))
            out[cell] = out.get(cell, 0) + 1
        return out

    df = np.zeros(langid.DIM)
    for _, t, _ in rows[:200]:
        df[list(counts(t))] += 1
    assert np.allclose(model.idf, np.log(201 / (1 + df)) + 1, atol=1e-5)
    want = {}
    for k, t, _ in rows[:200]:
        v = np.zeros(langid.DIM)
        for cell, n in counts(t).items():
            v[cell] = np.sqrt(n) * model.idf[cell]
        cosine = model.centroids @ (v / np.linalg.norm(v))
        by = [cosine[model.owner == j].max() for j in range(5)]
        want[k] = (model.languages[int(np.argmax(by))], max(by) / (max(by) + sorted(by)[-2]))
    for at_once in (400, 2):
        monkeypatch.setattr(langid, "LANGUAGES_AT_ONCE", at_once)
        got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
        assert all(got[k].lang_pred == lang and abs(got[k].score - score) < 1e-4 for k, (lang, score) in want.items())
        assert got[900].lang_pred == got[901].lang_pred == "und" and got[900].rejected


def test_repeated_ids_dont_widen_a_sample(spark):
    docs = spark.createDataFrame([(1, "the same text")] * 500 + [(2, f"text {k}") for k in range(500)] + [(3, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    some = labelled.sampled(docs, labels, (2, 1), 10, "t")
    rows = some.select("place", F.encode("text", "UTF-8").alias("x")).cache()
    assert rows.count() == 502
    a, b = labelled.collected(rows, 40, 1 << 20), labelled.collected(rows.repartition(7), 40, 1 << 20)
    assert a.num_rows == 40 and a.sort_by("place") == b.sort_by("place")
    assert labelled.collected(rows, 40, 50).num_rows < 8


def test_ftrl_weights_are_sparse():
    rng = np.random.default_rng(0)
    y = (rng.random(2000) < 0.5).astype(float)
    x = [np.unique(np.append(rng.integers(100, 5000, 20), [7] if t else [8])) for t in y]
    w, _ = toxicity.ftrl(x, y, epochs=2, l1=4.0)
    assert w[7] > 1 and w[8] < -1 and np.count_nonzero(w) < 100


def test_wave_file_and_odd_chunks():
    for n in (64, 128, 6400):
        raw = bytes(k % 256 for k in range(n))
        with wave.open(io.BytesIO(media.encode(raw))) as f:
            assert (f.getnchannels(), f.getsampwidth(), f.getframerate(), f.readframes(n)) == (1, 1, media.RATE, raw)
    stored = media.encode(b"x" * 64)
    assert media.decode(stored[:12] + b"LIST\x03\x00\x00\x00abc\x00" + stored[12:])[0] == b"x" * 64
    with pytest.raises(ValueError):
        media.decode(b"nothing")


def plain_resampled(x, up, down):
    """Every output by its own sum over the taps of its phase."""
    phases = media.prototype(up, down)
    taps = phases.shape[1]
    at = lambda i: (float(x[i]) - 128) / 128 if 0 <= i < len(x) else 0.0
    return np.array([sum(at(k * down // up + taps // 2 - j) * float(phases[k * down % up][j]) for j in range(taps)) for k in range(-(-len(x) * up // down))])


def plain_mel(y):
    """Frames by a discrete Fourier sum, triangles evaluated one by one."""
    frames = max(1, -(-max(0, len(y) - media.FRAME) // media.HOP) + 1)
    y = np.concatenate([y, np.zeros(frames * media.HOP + media.FRAME)])
    k, t = np.arange(media.FRAME // 2 + 1), np.arange(media.FRAME)
    wave = np.exp(-2j * np.pi * np.outer(t, k) / media.FRAME)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * t / media.FRAME)
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = [700 * (10 ** (mel(media.TARGET / 2) * i / (media.MELS + 1) / 2595) - 1) for i in range(media.MELS + 2)]
    out = []
    for f in range(frames):
        power = np.abs((y[f * media.HOP :][: media.FRAME] * window) @ wave) ** 2
        row = []
        for m in range(media.MELS):
            a, b, c = edges[m : m + 3]
            hz = k * media.TARGET / media.FRAME
            row.append(np.log((power * np.clip(np.minimum((hz - a) / (b - a), (c - hz) / (c - b)), 0, None)).sum() + 1e-6))
        out.append(row)
    return np.array(out)


def plain_segments(mel):
    energy = [np.log(sum(np.exp(float(v)) for v in row)) for row in mel]
    mean, found, begun = sum(energy) / len(energy), [], None
    for k, e in enumerate(energy):
        if begun is None and e - mean >= media.OPEN_AT:
            begun = k
        elif begun is not None and e - mean < media.CLOSE_AT:
            found.append((begun, k))
            begun = None
    return found + ([(begun, len(energy))] if begun is not None else [])


@pytest.mark.parametrize("rate", [16_000, 8_000, 10_000, 44_100, 7_001])
def test_features_against_plain_sums(rate):
    """Factors 5/8, 5/4, 1, 100/441 and 10000/7001, over quiet and loud stretches."""
    rng = np.random.default_rng(rate)
    n = int(0.4 * rate)
    loud = np.where((np.arange(n) // (n // 6)) % 2 == 0, 60, 3)
    x = np.clip(128 + loud * np.sin(2 * np.pi * 700 * np.arange(n) / rate) + rng.normal(0, 2, n), 0, 255).astype(np.uint8)
    up, down = media.factor(rate)
    assert up * rate == down * media.TARGET
    want = plain_resampled(x, up, down)
    got = media.resample(x, up, down, 0, len(want))
    assert np.allclose(got, want, atol=1e-5)
    pieces = np.concatenate([media.resample(x, up, down, a, min(a + 333, len(want))) for a in range(0, len(want), 333)])
    assert np.allclose(pieces, got, atol=1e-6)
    mel = media.log_mel(x.tobytes(), rate)
    assert np.allclose(mel, plain_mel(want), atol=2e-2) and media.segments(mel) == plain_segments(mel) != []


def test_resampler_keeps_low_tones_and_drops_high_ones():
    up, down = media.factor(media.RATE)
    assert up > 1 and down > 1
    t = np.arange(16_000) / media.RATE
    tone = lambda hz: np.round(128 + 100 * np.sin(2 * np.pi * hz * t)).astype(np.uint8)
    out = media.resample(tone(440), up, down, 0, 10_000)
    want = lambda delay: np.sin(2 * np.pi * 440 * (np.arange(10_000) / media.TARGET - delay / media.RATE))
    assert max(np.corrcoef(out[100:9800], want(d / 10)[100:9800])[0, 1] for d in range(-20, 21)) > 0.999
    assert media.resample(tone(7000), up, down, 0, 10_000)[100:9800].std() < 0.1 * out[100:9800].std()
    samples = np.random.default_rng(1).integers(0, 256, 1_400_000, np.uint8).tobytes()
    whole = media.log_mel(samples)
    head = media.log_mel(samples[:600_064])
    assert len(whole) > 2 * media.BLOCK_FRAMES and np.allclose(whole[: len(head) - 3], head[:-3], atol=1e-4)


def test_spans_follow_the_rate_of_the_file(spark):
    raw = bytes(128 + (100 if k // 2000 % 2 else 2) * (1 if k % 20 < 10 else -1) for k in range(16_000))
    d = spark.createDataFrame([(1, bytearray(media.encode(raw, 16_000))), (2, bytearray(media.encode(raw, 8_000))), (3, None)], "doc_id long, media binary")
    got = {r.doc_id: r for r in media.audio_features(d).collect()}
    assert (got[1].rate, got[2].rate, got[3].rate) == (16_000, 8_000, None)
    assert abs(got[1].patches[-1].end_s - 1.0) < 0.06 and abs(got[2].patches[-1].end_s - 2.0) < 0.06
    assert len(got[1].segments) == len(got[2].segments) == 4


def test_hysteresis():
    mel = np.log(np.array([[0.1], [10.0], [0.95], [10.0], [0.1], [0.95]]))
    mel = np.repeat(mel, 2, 1)
    energy = np.log(np.exp(mel).sum(1))
    energy -= energy.mean()
    found = media.segments(mel, float(energy[1]) - 0.01, float(energy[2]) - 0.01)
    assert found == [(1, 4)]


def test_tensor_has_a_fixed_shape(spark):
    mel = np.random.default_rng(0).normal(size=(70, media.MELS)).astype(np.float32)
    made = media.patches(mel)
    assert [round(p["start_s"], 4) for p in made] == [round(k * media.PATCH_FRAMES * media.HOP / media.TARGET, 4) for k in range(3)]
    found = media.audio_features(media.store(documents(spark))).select("doc_id", "frames", "patches").toArrow()
    column = media.tensors(found["patches"])
    assert isinstance(column.type, pa.FixedShapeTensorType) and column.type.shape == [media.PATCH_FRAMES, media.MELS]
    assert len(column) == sum(-(-n // media.PATCH_FRAMES) for n in found["frames"].to_pylist())
    first = column.to_numpy_ndarray()[0]
    assert np.allclose(first.ravel(), found["patches"][0].as_py()[0]["values"])


def test_media_query_against_plain_version(spark):
    from gridquill.llm.media import audio_features, store

    d = documents(spark)
    got = audio_features(store(d), ("doc_id", "n_bytes")).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in d.collect()}
    assert len(got) == d.count()
    for r in got:
        raw = texts[r.doc_id]
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert media.decode(bytes(r.media))[0] == payload
    assert store(empty(spark)).count() == 0


def test_words_and_shingles():
    data, offsets = utf8(pa.array(["A b  a\tB", None, "", "one two three four five six", "a b"]))
    w = Words(data, offsets)
    assert w.count.tolist() == [4, 0, 0, 6, 2] and w.hash[0] == w.hash[2] and w.hash[1] == w.hash[3]
    assert len(windows(w, 5)[0]) == 2
    sets = shingle_sets(data, offsets)
    assert [len(s) for s in sets] == [1, 0, 0, 2, 1]
