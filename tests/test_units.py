"""Truth tables and properties of the parts."""

import io
import math
import random
import re
import time
import wave
import zipfile
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillcast.functions import text
from quillcast.operators import align, audio, classifier, labels, names, paragraphs, sampling, scores, split
from quillcast.sources import documents, tables
from quillcast.streaming import resume


def naive(q, t):
    row = [0] * (len(t) + 1)
    for i, a in enumerate(q, 1):
        new = [i]
        for j, b in enumerate(t, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("ab в", min_size=1, max_size=12), st.text("ab в", min_size=1, max_size=30))
def test_infix_is_the_plain_distance(q, t):
    d = naive(q, t)
    assert align.infix_distance(q, t) == d
    start, end, found = align.infix_locate(q, t)
    assert found == d
    if end >= start:
        part = t[start : end + 1]
        row = list(range(len(part) + 1))
        for i, a in enumerate(q, 1):
            new = [i]
            for j, b in enumerate(part, 1):
                new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
            row = new
        assert row[-1] == d


def test_cut_off_and_empty():
    assert align.infix_distance("", "a") is None and align.infix_distance("a", "") is None
    assert align.infix_distance("abcdef", "zzzzzz", 3) is None
    assert align.gate([], [])[0] == "no_sample" and align.gate([10, 10], [None, 3]) == ("ok", [None, 0.3]) and align.gate([10], [4])[0] == "mismatch"


def test_matching_moves_on_and_falls_back():
    rng = random.Random(4)
    words = ["".join(rng.choice("абвгдежз") for _ in range(6)) for _ in range(210)]
    a = align.Audio(words, list(range(len(words))), [i + 0.5 for i in range(len(words))], [0.9] * len(words))
    frags = [{"chunk_text": " ".join(words[k * 7 : k * 7 + 7]), "speech": " ".join(words[k * 7 + 1 : k * 7 + 7])} for k in (3, 10, 2)]
    out = align.match_fragments(frags, a)
    assert [m["match_start_ts"] for m in out] == [22, 71, 15]
    assert [m["search_window_expanded"] for m in out] == [False, False, True]


def test_descriptions(spark):
    cases = [("", None, True), (" — ", None, True), ("NULL", None, True), ("сказал.", None, True), ("Сказала она", None, True), ("сказал громко", None, False), ("без  описания манеры", None, True), ("нет", None, True), ("Тихо!", "— тихо", True), ("шёпотом", "Тихо", False), (None, None, True)]
    df = spark.createDataFrame([(i, d, s) for i, (d, s, _) in enumerate(cases)], "i int, d string, s string")
    got = {r.i: r.j for r in df.select("i", text.is_junk_description(F.col("d"), F.col("s")).alias("j")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[2] for c in cases]


def test_dialogue_and_guard(spark):
    df = spark.createDataFrame([("— Да.", True), ("a\n- Да", True), ("a — б", False), ("«б»", True), ("«»", False), ('"ab"', True), ('"a"', False), ('"a\nb"', False)], "t string, want boolean")
    assert all(r.want == r.got for r in df.select("want", text.has_dialogue(F.col("t")).alias("got")).collect())
    g = spark.createDataFrame([("«Да,  Я»", 'он: "да, я"', True), ("Нет", "да", False), ("", "да", False)], "s string, c string, want boolean")
    assert all(r.want == r.got for r in g.select("want", text.speech_in_chunk(F.col("s"), F.col("c")).alias("got")).collect())


def test_flags_edges(spark):
    df = spark.createDataFrame([(0.0, 0.4, "a b c"), (0.39, 0.399, "a b c d"), (0.4, None, ""), (60.0, float("nan"), None), (59.999, 0.1, "a b c d"), (None, 0.1, "a b c d")], "duration_s double, match_distance_norm double, speech string")
    out = scores.junk_flags(df).select("junk_any_hard", "junk_badmatch", "junk_few_words").collect()
    assert [tuple(r) for r in out] == [(True, True, True), (True, False, False), (False, False, True), (True, False, True), (False, False, False), (False, False, False)]


def test_scores_round_before_thresholds(spark):
    df = spark.createDataFrame([(0.4996, "high"), (0.4994, "high"), (-1.001, "high"), (-1.0, "high"), (None, "low"), (9.0, "neutral")], "x double, loudness string")
    df = df.withColumns({"f": F.col("x"), "f_med": F.lit(0.0), "f_scale": F.lit(1.0)})
    out = scores.delivery(df, {"loudness": "f"}).select("manner_bucket", "underdelivery").collect()
    assert [tuple(r) for r in out] == [("confirmed", False), ("unconfirmed", False), ("unconfirmed", True), ("unconfirmed", False), ("unconfirmed", False), ("neutral", False)]


def test_zero_scale_does_not_fall_through(spark):
    base = spark.createDataFrame([("r", "b", 1.0, 0.0), ("r", "c", 3.0, 2.0)], "reader string, book_name string, m double, s double")
    rows = spark.createDataFrame([("r", "b"), ("r", "z"), ("q", "z")], "reader string, book_name string")
    out = {(r.reader, r.book_name): (r.m, r.s) for r in scores.hierarchical_fallback(rows, base, ["m", "s"]).collect()}
    assert out == {("r", "b"): (1.0, 0.0), ("r", "z"): (2.0, 1.0), ("q", "z"): (2.0, 1.0)}


def test_split_covers_each_reader_once(spark):
    rows = [(f"r{i}", "mf"[i % 2], float(1 + i * 7 % 11)) for i in range(31)]
    out = split.lpt_split(spark.createDataFrame(rows, "reader string, reader_gender string, hours double")).collect()
    assert sorted(r.reader for r in out) == sorted(r[0] for r in rows)
    assert {r.split for r in out} == {"train", "val", "test"}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=12))
def test_chunks_hold_everything(spark, sizes):
    ps = [chr(97 + i % 26) * n for i, n in enumerate(sizes)]
    df = spark.createDataFrame([(ps,)], "p array<string>")
    got = df.select(paragraphs.pack_paragraphs(F.col("p"), 30).alias("c")).first().c
    want, now, n = [], [], 0
    for p in ps:
        if now and n + len(p) > 30:
            want.append("\n\n".join(now))
            now, n = [], 0
        now.append(p)
        n += len(p)
    assert got == want + (["\n\n".join(now)] if now else [])


def test_names_leave_no_leak(spark):
    df = spark.createDataFrame([("тихо сказал Иван Петров", "Иван Петров"), ("голосом Ивана.", "Иван"), ("Иваново детство", "Иван"), ("a.b тихо", "a.b"), ("он", "он"), ("Пётр", "Пётр")], "description string, character string")
    out = {r.description: (r.description_anon, r.changed) for r in names.anonymize(df).collect()}
    assert out["тихо сказал Иван Петров"] == ("тихо сказал", True)
    assert out["Иваново детство"][0] == "Иваново детство"
    assert out["a.b тихо"] == ("тихо", True)
    assert out["Пётр"] == ("Пётр", False)


def test_html_nested_twice_and_epub():
    assert documents.html_paragraphs("<div> a <p>b<b>c</b></p></div><p>d<p>e") == ["a b c", "b c", "d", "e"]
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("b.xhtml", "<p>two</p>")
        z.writestr("a.xhtml", "<p>one</p>")
        z.writestr("c.opf", '<item id="x" href="a.xhtml"/><item id="y" href="b.xhtml"/><itemref idref="x"/><itemref idref="y"/>')
    assert documents.epub_paragraphs(buf.getvalue()) == ["one", "two"]


def wav(y, sr=16000):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(sr)
        w.writeframes((y * 32767).astype("<i2").tobytes())
    return out.getvalue()


def test_audio_measures(spark):
    t = np.arange(16000) / 16000
    y = 0.5 * np.sin(2 * np.pi * 120 * t) + 0.2 * np.sin(2 * np.pi * 240 * t)
    m = audio.measure(y, 16000)
    assert abs(m["f0_median_hz"] - 120) < 8 and m["voiced_ratio"] > 0.9 and m["clipping_ratio"] == 0
    df = spark.createDataFrame([(1, wav(y)), (2, b"broken")], "k int, content binary")
    got = {r.k: r.feat_status for r in audio.features(df, "k").collect()}
    assert got[1] == "ok" and got[2].startswith("error:")
    s = spark.createDataFrame([(None, 1, 1, 1.0), (0, 1, 1, 1.0), (9, None, 1, 1.0), (9, 0, 24000, 1.0), (9, 24000, 24000, 1.15), (9, 24000, 24000, 1.151)], "size int, n int, sr int, d double")
    assert [r.x for r in s.select(audio.header_status(F.col("size"), F.col("n"), F.col("sr"), F.col("d")).alias("x")).collect()] == ["missing", "empty", "header_unreadable", "zero_frames", "ok", "dur_mismatch(got=1.00,exp=1.15)"]


def test_spectra_of_known_waves():
    sr = 24000
    t = np.arange(2 * sr) / sr
    tone, noise = 0.5 * np.sin(2 * np.pi * 1500 * t), np.random.default_rng(4).normal(0, 0.1, 2 * sr)
    m, n = audio.measure(tone, sr), audio.measure(noise, sr)
    assert abs(m["spec_centroid_mean"] - 1500) < 60 and abs(m["spec_rolloff_mean"] - 1500) < 60 and m["spec_flatness_mean"] < 0.01 and m["hf_energy_ratio"] < 0.01
    assert abs(m["zcr_mean"] - 2 * 1500 / sr) < 0.002 and m["harmonic_ratio"] > 0.95
    assert abs(n["spec_centroid_mean"] - sr / 4) < 300 and abs(n["spec_rolloff_mean"] - 0.85 * sr / 2) < 300 and n["spec_flatness_mean"] > 0.4
    assert abs(n["hf_energy_ratio"] - 2 / 3) < 0.03 and n["harmonic_ratio"] < 0.7
    # separated parts add up to the whole, and clicks are struck, not steady
    spectra = audio._magnitudes(tone, audio.WIDE, audio.WIDE_HOP)
    assert np.allclose(audio._back(spectra, audio.WIDE, audio.WIDE_HOP, len(tone))[1024:-2048], tone[1024:-2048], atol=1e-9)
    clicks = np.zeros(2 * sr)
    for k in range(7):
        clicks[3000 + 6000 * k :][:240] = np.random.default_rng(k).normal(0, 0.5, 240)
    assert audio.harmonic_share(clicks) < 0.3 and len(audio.onsets(clicks, sr)) == 7
    assert not len(audio.onsets(np.zeros(sr), sr)) and set(audio.measure(np.zeros(sr), sr)) == set(audio.FEATURES)


def test_files_are_verified_by_header_and_by_decoding(spark):
    good = wav(np.zeros(24000), 24000)
    flac = b"fLaC" + bytes([0, 0, 0, 34]) + bytes(10) + ((24000 << 44) | (1 << 41) | (15 << 36) | 48000).to_bytes(8, "big") + bytes(16)
    assert audio.read_header(flac) == (48000, 24000)
    files = spark.createDataFrame([("a", good), ("b", b""), ("c", b"junk"), ("d", flac)], "k string, content binary")
    rows = spark.createDataFrame([("a", 1.1), ("b", 1.0), ("c", 1.0), ("d", 1.0), ("e", 1.0)], "k string, d double")
    got = {r.k: r.verify_status for r in audio.verify(rows, files, "k", "d").collect()}
    assert got == {"a": "ok", "b": "empty", "c": "header_unreadable:EOFError", "d": "dur_mismatch(got=2.00,exp=1.00)", "e": "missing"}

    def tester(content):
        return None if content[:4] == b"RIFF" else "flac_test_fail:x"

    deep = {r.k: r.verify_status for r in audio.deep_check(files.union(spark.createDataFrame([("e", None)], files.schema)), "k", tester=tester).collect()}
    assert deep == {"a": "ok", "b": "flac_test_fail:x", "c": "flac_test_fail:x", "d": "flac_test_fail:x", "e": "missing"}

    class Two:
        names = ["lo", "hi"]

        def __call__(self, y, sr):
            return [float(y.min()), float(y.max())]

    more = audio.features(files.filter("k = 'a'"), "k", more=Two()).first()
    assert more.feat_status == "ok" and more.egm_lo == 0.0 and more.egm_hi == 0.0


def test_every_book_has_a_baseline_status(spark):
    books = spark.createDataFrame([("r", b, b != "gone") for b in ("fine", "gone", "short", "mute", "broken")], "reader string, book string, present boolean")
    seg = [("r", "fine", k, 0.0, 2.0, 3, float(k), "ok") for k in range(5)] + [("r", "short", 9, 0.0, 0.5, 3, 1.0, "ok"), ("r", "mute", 10, 0.0, 2.0, 3, None, "ok")]
    seg += [("r", "broken", 11, 0.0, 2.0, 3, 1.0, "ok"), ("r", "broken", 12, 0.0, 2.0, 3, None, "error:OSError")]
    df = spark.createDataFrame(seg, "reader string, book string, id int, start double, end double, n_words int, f double, feat_status string")
    out = {r.book: (r.base_status, r.n_segments, r.f_med) for r in audio.narration_baseline(df, ["reader", "book"], ["f"], "id", books=books).collect()}
    assert out == {"fine": ("ok", 5, 2.0), "gone": ("missing_json_or_mp3", 0, None), "short": ("no_segments", 0, None), "mute": ("no_features", 0, None), "broken": ("error:OSError", 0, None)}


def test_services_fail_softly(spark):
    def broken(_):
        raise TimeoutError

    df = spark.createDataFrame([("тихо",), (" тихо ",), ("",)], "description string")
    assert labels.axes_of(df, labels.Fake()).count() == 1
    out = labels.ask(df.limit(1), "description", broken, retries=1).first()
    assert out.reply is None and out.reply_status == "error:TimeoutError"


def test_samples_and_resume(spark, tmp_path):
    df = spark.range(50).withColumnRenamed("id", "k")
    s = sampling.disjoint_samples(df, "k", {"a": 10, "b": 5}).toPandas()
    assert s.groupby("sample").size().to_dict() == {"a": 10, "b": 5} and s.k.is_unique
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    df.write.parquet(src)
    resume.run_new(spark, src, "k bigint", out, ck)
    df.limit(3).write.mode("append").parquet(src)
    resume.run_new(spark, src, "k bigint", out, ck)
    assert spark.read.parquet(out).count() == 53
    tables.rewrite(spark, out, lambda d: d.filter("k < 10"))
    assert spark.read.parquet(out).filter("k >= 10").count() == 0


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('a "q", b', "x\ny"), ("ж", None)], "a string, b string")
    p = str(tmp_path / "c")
    tables.write_csv(df, p)
    assert sorted(map(tuple, tables.read_csv(spark, p, "a string, b string").collect())) == sorted(map(tuple, df.collect()))


def test_manner_flags():
    assert classifier.manner_flags("шёпотом")[0] and classifier.manner_flags("сказал с гордостью")[1]
    assert classifier.tag_window("«а» тихо и ясно «б» громко", 5) == " тихо  гром"


def test_hybrid_classifier_is_plain_tf_idf_and_logistic_regression(spark, tmp_path):
    from quillcast.plans import catalog

    rng = np.random.default_rng(4)
    lexicon = ["".join(rng.choice(list("abcdefghijklmnopqrst"), 9)) for _ in range(600)]
    y = [k % 2 for k in range(50)]
    texts = [" ".join([*rng.choice(lexicon[: 300 + 250 * v], 90), *(["шёпотом"] * (k % 5 == 0))]) for k, v in enumerate(y)]
    contexts = [f"site{k % 3}.org" for k in range(50)]
    spark.createDataFrame(list(zip(range(50), texts, ["en"] * 50, contexts)), "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, v, 0) for k, v in enumerate(y)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r.prob for r in catalog.QUERIES["q40_hybrid_classifier"](spark, str(tmp_path)).collect()}

    def unit_tf_idf(column):
        grams = [Counter(f" {w} "[i : i + n] for w in t.split() for n in (3, 4, 5) for i in range(len(w) + 3 - n)) for t in column]
        df = Counter(g for c in grams for g in c)
        terms = {g: j for j, g in enumerate(g for g in df if df[g] > 1)}
        x = np.zeros((len(column), len(terms)))
        for k, c in enumerate(grams):
            for g, m in c.items():
                if g in terms:
                    x[k, terms[g]] = m * (math.log((len(column) + 1) / (df[g] + 1)) + 1)
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)

    x = np.hstack([unit_tf_idf(texts), unit_tf_idf(contexts), np.array([classifier.manner_flags(t) for t in texts], float)])
    assert 5000 < x.shape[1] < 50_000
    # Newton's method on the dual weights and the intercept; classes are of equal size, so every row weighs one
    kernel, t, a, b = x @ x.T, np.array(y), np.zeros(50), 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-(kernel @ a + b)))
        s = p * (1 - p)
        grad = np.append(p - t + a, (p - t).sum())
        step = np.linalg.solve(np.block([[s[:, None] * kernel + np.eye(50), s[:, None]], [s @ kernel, s.sum()]]), grad)
        a, b = a - step[:50], b - step[50]
    assert np.allclose([got[k] for k in range(50)], 1 / (1 + np.exp(-(kernel @ a + b))), atol=1e-3)


def test_safe_name_reads_the_end_and_the_whole_where_it_must(spark):
    rng = random.Random(8)
    texts = [None, "", "_", "a", "ab" * 400, "x" * 149 + "!" * 400, "x" * 150 + "!" * 250, "x" * 151 + "!" * 249, "début" + "!" * 3000 + "fin", "я" * 500 + "_" * 1000, "\U0001f600a" * 500, "?" * 900, "a" + "?" * 399, "a" + "?" * 400]
    texts += ["".join(rng.choice("aЖ0" + "_ é!" * rng.choice((1, 30))) for _ in range(rng.randint(1, 1500))) for _ in range(300)]
    got = {r.t: r.safe for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.safe_name(F.col("t")).alias("safe")).collect()}
    assert got == {t: t if t is None else re.sub("[^0-9a-zA-Zа-яА-Я]+", "_", t).strip("_")[-150:] for t in texts}

    def seconds(name):
        long = spark.range(1000).select(F.concat(F.repeat(F.lit("ab cd, "), 3000), F.col("id").cast("string")).alias("t"))
        began = time.perf_counter()
        long.select(name).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    # of texts with a long name, most is not rewritten
    assert min(seconds(text.safe_name(F.col("t"))) for _ in range(2)) < seconds(F.regexp_replace("t", "[^0-9a-zA-Zа-яА-Я]+", "_"))


def test_lemmas_are_removed_by_slices(spark, monkeypatch):
    import pyarrow as pa

    taken = {}
    monkeypatch.setattr(names, "SLICE_CHARS", 100)
    df = spark.createDataFrame([("x", ["x"], 1)], "t string, ns array<string>, more int")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: taken.setdefault("run", run))
    names.remove_lemmas(df, "t", "ns")
    rows = [("Иваном сказал ivan", ["Иван"], k) for k in range(50)] + [(None, ["Иван"], 50), ("Иван", None, 51), ("Иван", [], 52), ("", ["a"], 53)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.list_(pa.string()), pa.int32()))], ["t", "ns", "more"])
    out = list(taken["run"](iter([batch, batch.slice(0, 0)])))
    # a batch isn't held twice over: it goes back in pieces, with its other columns as they were
    assert len(out) > 5 and all(sum(len(t or "") for t in b.column(0).to_pylist()) < 200 for b in out)
    assert [r for b in out for r in b.to_pylist()] == [{"t": "  сказал ivan" if k < 50 else t, "ns": n, "more": k} for t, n, k in rows]


def test_grams_are_counted_as_plain_strings_are(monkeypatch):
    rng = random.Random(3)
    texts = [None, "", " \n", "a", "Ab  ab\u2003É\x1cx", "ж ёж", "x\U0001f600y x\U0001f600y"] + [" ".join("".join(rng.choice("abcdeж\u4e2d") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += ["".join(map(chr, range(0x4E00, 0x4E00 + 6300))), "".join(map(chr, range(0x4E00 + 3000, 0x4E00 + 9100)))]  # more letters than digits, in one text and in two
    monkeypatch.setattr(classifier, "HELD_TERMS", 300)
    plain = [Counter(f" {w} "[i : i + n] for w in re.findall(r"[^ \n\u2003]+", (t or "").lower()) for n in (3, 4, 5) for i in range(len(w) + 3 - n)) for t in texts]
    counts, tf, df = classifier.Counts(), Counter(), Counter()
    sent = [x for t in texts for x in counts.add(t)] + counts.taken()
    for terms, a, b in sent:
        tf.update(dict(zip(terms, a.tolist(), strict=True)))
        df.update(dict(zip(terms, b.tolist(), strict=True)))
    assert len(sent) > 3 and tf == sum(plain, Counter()) and df == Counter(g for c in plain for g in c)
    for terms in ([g for g in tf if df[g] > 1], [g for g in tf if not set(g) & set("abc")]):  # the second has too many letters
        look_up, known = classifier.Vocabulary(terms), set(terms)
        assert (look_up.ids is None) == (len(set("".join(terms))) < classifier.BASE - 1)
        for t, c in zip(texts, plain, strict=True):
            ids, n = look_up(t)
            assert {terms[i]: k for i, k in zip(ids, n.tolist(), strict=True)} == {g: k for g, k in c.items() if g in known}


def test_classifier_takes_terms_by_count_then_order_and_is_kept(spark, tmp_path):
    rows = [(k, ("abcd" if k < 10 else "wxyz") + " tie uvw", float(k < 10), "s", 0.0, float(k % 2), [k]) for k in range(20)]
    df = spark.createDataFrame(rows, "k int, text string, label double, context string, v1 double, v2 double, more array<int>")
    model = classifier.fit(df, vocabulary=7)
    # 20 of each of the six whose words are in every row, then 10 of each of the others
    assert model.terms[0] == sorted(g for w in ("tie", "uvw") for g in classifier.char_ngrams(w))[:7] and model.terms[1] == [" s "]
    model = classifier.fit(df)
    classifier.save(model, f"{tmp_path}/m")
    one, two = (sorted(map(tuple, classifier.score(m, df).select("k", "prob", "more").collect())) for m in (model, classifier.load(f"{tmp_path}/m")))
    assert one == two and [p > 0.5 for _, p, _ in one] == [k < 10 for k in range(20)]
    assert {r.prob for r in classifier.score(classifier.fit(df.filter("label = 1")), df).collect()} == {1.0}
    assert dict(df.dtypes).items() <= dict(classifier.score(model, df).dtypes).items()


def test_matching_carries_columns_and_names_bad_pairs(spark):
    rng = random.Random(5)
    told = [" ".join("".join(rng.choice("абвгдежз") for _ in range(6)) for _ in range(30)) for _ in range(4)]
    frags = [("b", "r", a, k, 0, t, t[7:40], f"how {k}", "Name", "Author") for a in ("good", "other", "mute", "none") for k, t in enumerate(told)]
    frags = spark.createDataFrame(frags, "path_book string, reader string, path_audio string, chunk_id long, pos long, chunk_text string, speech string, description string, book_name string, book_author string")
    heard = [("good", i, w) for i, w in enumerate(" ".join(told).split())] + [("other", i, "юю") for i in range(50)] + [("mute", None, None)]
    words = spark.createDataFrame([(a, i, w, None if i is None else float(i), None if i is None else i + 0.5, 0.9) for a, i, w in heard], "path_audio string, word_idx long, word string, start double, end double, score double")
    tagged = align.match_all(frags, words).cache()
    got = {(r.path_audio, r.chunk_id): (r.match_status, r.description, r.match_distance) for r in align.matched(tagged).collect()}
    assert got == {("good", k): ("ok", f"how {k}", 0) for k in range(4)} | {("none", k): ("no_audio_json", f"how {k}", None) for k in range(4)}
    bad = {r.path_audio: (r.match_status, r.book_name, r.book_author, r.n_fragments_skipped) for r in align.bad_pairs(tagged).collect()}
    assert bad == {a: ("mismatch", "Name", "Author", 4) for a in ("other", "mute")}
    assert tuple(align.match_summary(tagged).first()) == (8, 4, 0, 2, 8)


def test_pair_check_names_each_fault(spark):
    text = "абвгд еёжзи клмно"
    rows = [("a", text, text, None, None), ("b", None, None, "torn", None), ("c", None, text, "torn", None), ("d", None, text, None, "bad"), ("e", text, None, None, "bad"), ("f", text, "", None, None), ("g", text, "я" * 40, None, None)]
    out = align.check_pairs(spark.createDataFrame(rows, "k string, sample_text string, audio_text string, be string, ae string"), book_error="be", audio_error="ae").cache()
    assert {r.k: r.status for r in out.collect()} == {"a": "ok", "b": "no_audio_json", "c": "epub_parse_error: torn", "d": "no_sample_paragraph", "e": "audio_json_error: bad", "f": "empty_audio", "g": "mismatch"}
    assert {r.status: round(r.rate * 7) for r in align.check_summary(out).collect()}["epub_parse_error"] == 1


def test_transcripts_by_their_folders(spark, tmp_path):
    for title, name in (("a b+c", "a b+c"), ("d", "d"), ("d", "stray")):
        folder = tmp_path / title / "raw"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.json").write_text('[{"start": 5, "end": 6, "words": []}, {"start": 1, "end": 2, "words": [{"word": "x", "start": 1, "end": 2}]}]')
    rows = tables.read_transcripts(spark, f"{tmp_path}/*/raw/*.json").collect()
    assert sorted((r.path_audio, r.seg, r.start) for r in rows) == [(f"{tmp_path}/{t}", k, s) for t in ("a b+c", "d") for k, s in ((0, 5.0), (1, 1.0))]


def test_six_flags_hold_out_and_filter(spark):
    rows = [(b, i, "сказал шёпотом тихо" if (b + i) % 2 else "дом стоит у реки", float((b + i) % 2)) for b in range(8) for i in range(4)]
    df = spark.createDataFrame(rows, "book int, i int, text string, label double")
    full = classifier.with_neighbours(df, "book", "i").cache()
    one = full.filter("book = 0").orderBy("i").collect()
    assert [tuple(r[f] for f in classifier.FLAGS[::2]) for r in one] == [(0, 0, 1), (1, 0, 0), (0, 1, 1), (1, 0, 0)] and one[0].context == " сказал шёпотом тихо"
    assert classifier.pos_filter(df, "text").count() == 16 and classifier.pos_filter(df, "text").columns == df.columns
    sweep, _ = classifier.hold_out(full.filter("book < 6"), full.filter("book >= 6"), "book", [0.5], flags=classifier.FLAGS, max_iter=20)
    assert tuple(sweep.select("kept", "total", "recall").first()) == (4, 8, 1.0)
    try:
        classifier.hold_out(full, full.filter("book = 1"), "book", [0.5])
        raise AssertionError
    except ValueError as e:
        assert "1" in str(e)


def test_seeded_distances_are_those_of_a_whole_scan():
    import random

    rng = random.Random(4)
    for _ in range(300):
        target = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(1, 300)))
        a = rng.randint(0, len(target) - 1)
        query = list(target[a : a + rng.randint(1, 120)])
        for _ in range(rng.randint(0, 12)):
            i = rng.randint(0, len(query))
            query[i : i + rng.randint(0, 1)] = rng.choice(["", "x", "a"])
        query = "".join(query) or "z"
        scores = list(align._edits_at_ends(query, target))
        best = min(scores)
        assert align.infix_distance(query, target) == min(best, len(query))
        assert align.infix_locate(query, target)[1:] == (scores.index(best), best)
        for limit in (0, 3, 10):
            assert align.infix_distance(query, target, limit) == (min(best, len(query)) if min(best, len(query)) <= limit else None)
